"""Main text of web pages by gradient-boosted trees over DOM nodes, decoded along the tree.

The trees tell for every block element how likely it is part of the article, from its tag and attribute
tokens, those of its ancestors, its depth, the text and link density of its subtree and its siblings.
They learn from pages whose answer is known: layouts of many kinds are composed from the sentences of a
bounded sample of the given pages, with menus, notices, adverts, forms and readers' comments around and
inside the article.

Decoding labels all nodes at once: outside, article or excluded. Below an article node there are article
or excluded nodes, below an excluded one only excluded ones; the likeliest such labelling is found from
the leaves up. So no menu inside an article's advert and no article inside a footer can come out.
"""

from __future__ import annotations

import html
import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revisit.llm import boosting, dom

SAMPLE_PAGES = 200
TRAINING_PAGES = 600
SAMPLE_RUNS, SAMPLE_CHARS = 60, 2000  # blocks of a sampled page, and code points of each, that training layouts are composed from
VOCABULARY = 180

# How pages name their parts: prior knowledge about the web that the composed layouts show.
ARTICLE_NAMES = "article content post entry story main-content post-content entry-content article-body article-content post-body text page-content blog-post body-text prose news-item single hentry".split()
WRAPPER_NAMES = "container wrapper page site row col inner main layout wrap body grid outer holder content-wrapper".split()
BOILERPLATE = {
    "menu": "nav navbar navigation menu main-menu topnav breadcrumb breadcrumbs site-nav nav-links pagination pager toc skip-links".split(),
    "header": "header site-header masthead top-bar banner logo branding page-header topbar site-title".split(),
    "footer": "footer site-footer bottom copyright colophon legal page-footer imprint".split(),
    "sidebar": "sidebar side aside widget widgets related recommended trending popular more-stories tags categories archive right-column rail teaser see-also author-box".split(),
    "notice": "cookie cookies consent notice gdpr alert popup modal overlay disclaimer warning message paywall announcement cookie-banner hidden".split(),
    "ad": "ad ads advert advertisement adsbygoogle sponsor sponsored promo promotion ad-slot banner-ad commercial advertorial".split(),
    "form": "form newsletter subscribe signup search login contact feedback search-form poll".split(),
    "comments": "comments comment-list commentlist comment reply replies respond disqus discussion reader-comments reactions responses user-comments".split(),
    "share": "share social sharing follow share-buttons social-links".split(),
}
OWN_TAGS = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form", "comments": "section", "notice": "div", "ad": "div", "share": "div"}

GOOD, BAD = "zzarticle", "zzother"


class Composer:
    """Random pages in which the article and all else are marked by a class."""

    def __init__(self, runs: list[str], seed: int) -> None:
        self.rng = np.random.default_rng(seed)
        self.pool = [s for run in runs for s in re.split(r"(?<=[.!?])\s+", run) if s] or ["word"]

    def some(self, options: list) -> object:
        return options[int(self.rng.integers(len(options)))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def words(self, low: int, high: int) -> str:
        out, want = [], int(np.exp(self.rng.uniform(np.log(low), np.log(high + 1))))
        while len(out) < want:
            out += str(self.some(self.pool)).split()
        return html.escape(" ".join(out[:want]), quote=False)

    def prose(self, low: int = 2, high: int = 160) -> str:
        text = self.words(low, high)
        if self.chance(0.15):
            text = f"<b>{text}<br>" if self.chance(0.5) else f"<em>{text}</em> {self.words(1, 20)}"
        if self.chance(0.12):
            text += f' <a href="/x">{self.words(1, 4)}</a> {self.words(1, 15)}'
        return text

    def named(self, tag: str, names: list[str], mark: str, inside: str) -> str:
        name = str(self.some(names))
        if self.chance(0.15):
            name += " " + str(self.some(names))
        attr = f'id="{name}" class="{mark}"' if self.chance(0.25) else f'class="{name} {mark}"'
        return f"<{tag} {attr}>{inside}</{tag}>"

    def links(self, low: int = 2, high: int = 9) -> str:
        items = [f'<a href="/{i}">{self.words(1, 4)}</a>' for i in range(int(self.rng.integers(low, high)))]
        shape = int(self.rng.integers(3))
        return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>" if shape == 0 else " | ".join(items) if shape == 1 else "".join(f"<div>{i}</div>" for i in items)

    def extra(self, kind: str, inside_article: bool = False) -> str:
        if kind in ("menu", "share"):
            inside = self.links()
        elif kind == "header":
            inside = f"<h1>{self.words(1, 5)}</h1>" * self.chance(0.4) + f"<div>{self.words(1, 6)}</div>" * self.chance(0.6) + self.links() * self.chance(0.5) + f"<p>{self.words(2, 12)}</p>"
        elif kind == "footer":
            inside = "".join((f"<p>{self.prose(2, 40)}</p>" if self.chance(0.6) else f"&copy; {self.words(1, 12)}") for _ in range(int(self.rng.integers(1, 3)))) + self.links() * self.chance(0.4)
        elif kind == "sidebar":
            inside = f"<h3>{self.words(1, 4)}</h3>" * self.chance(0.6) + (self.links() if self.chance(0.5) else "".join(f"<p>{self.prose(3, 50)}</p>" for _ in range(int(self.rng.integers(1, 4)))))
        elif kind == "form":
            inside = f"<p>{self.words(2, 25)}</p>" * self.chance(0.5) + f"<label>{self.words(1, 4)}</label><input name=q><button>{self.words(1, 2)}</button>" + f"<div>{self.words(2, 12)}</div>" * self.chance(0.4)
        elif kind == "comments":
            one = lambda: self.named("li" if self.chance(0.4) else "div", ["comment", "reply", "item", "message"], BAD, f"<p>{self.prose(3, 90)}</p>" + f"<span>{self.words(1, 3)}</span>" * self.chance(0.5))
            inside = f"<h2>{self.words(1, 4)}</h2>" * self.chance(0.7) + "".join(one() for _ in range(int(self.rng.integers(1, 6))))
        else:
            inside = self.prose(2, 60) if self.chance(0.5) else f"<p>{self.prose(2, 60)}</p>"
        tag = OWN_TAGS[kind] if self.chance(0.55) else str(self.some(["div", "div", "section", "p" if "<" not in inside else "div"]))
        if kind in ("menu", "header", "footer", "sidebar", "form") and tag == OWN_TAGS[kind] and self.chance(0.45):
            return f'<{tag} class="{BAD}">{inside}</{tag}>'
        return self.named(tag, BOILERPLATE[kind], BAD, inside)

    def article(self) -> list[str]:
        blocks = [f"<h1>{self.words(2, 14)}</h1>"] if self.chance(0.8) else []
        for _ in range(int(np.exp(self.rng.uniform(0, 3.2)))):
            kind = self.rng.random()
            if kind < 0.72:
                blocks.append(f"<p>{self.prose()}</p>" if self.chance(0.85) else f"<p>{self.prose()}")
            elif kind < 0.80:
                blocks.append(f"<h2>{self.words(1, 8)}</h2>" if self.chance(0.6) else f"<h3>{self.words(1, 8)}</h3>")
            elif kind < 0.86:
                tag = str(self.some(["ul", "ol"]))
                blocks.append(f"<{tag}>" + "".join(f"<li>{self.prose(1, 30)}</li>" for _ in range(int(self.rng.integers(2, 7)))) + f"</{tag}>")
            elif kind < 0.90:
                blocks.append(f"<blockquote><p>{self.prose(3, 50)}</p></blockquote>" if self.chance(0.6) else f"<blockquote>{self.prose(3, 50)}</blockquote>")
            elif kind < 0.93:
                blocks.append("<table>" + "".join("<tr>" + "".join(f"<td>{self.words(1, 5)}</td>" for _ in range(3)) + "</tr>" for _ in range(int(self.rng.integers(1, 5)))) + "</table>")
            elif kind < 0.96:
                blocks.append(str(self.some([f"<pre>{self.words(3, 30)}</pre>", f"<figure><img src=x><figcaption>{self.words(2, 15)}</figcaption></figure>"])))
            else:
                blocks.append(f"<div>{self.prose(3, 80)}</div>" if self.chance(0.5) else f"<section><h2>{self.words(1, 6)}</h2><p>{self.prose()}</p></section>")
        for kind in ("ad", "share", "sidebar", "form", "notice", "menu"):
            if self.chance(0.14):
                blocks.insert(int(self.rng.integers(len(blocks) + 1)), self.extra(kind, True))
        if self.chance(0.1):
            blocks.append(self.extra("comments", True))
        return blocks

    def plain(self) -> str:
        """Text without blocks, with line breaks between its paragraphs, and now and then a menu or a notice."""
        parts = [self.prose(8, 160) for _ in range(int(self.rng.integers(1, 7)))]
        if self.chance(0.3):
            parts.insert(int(self.rng.integers(len(parts) + 1)), self.extra(str(self.some(["ad", "menu", "share", "notice", "form"])), True))
        return str(self.some(["<br>", "<br><br>", "<br/>\n<br/>"])).join(parts)

    def page(self) -> tuple[str, bool]:
        """A page, and whether its root itself holds the article's text."""
        blocks, kind = self.article(), self.rng.random()
        inside, bare, root = "".join(blocks), False, False
        if kind < 0.12:  # blocks of their own beside menus and footers
            main = "".join(b if BAD in b[: b.find(">")] else re.sub(r"^<(\w+)", rf'<\1 class="{GOOD}"', b) for b in blocks)
            bare = self.chance(0.7)
        elif kind < 0.20:
            main, bare = self.plain(), True
            root = self.chance(0.4)
        elif kind < 0.42:
            main = f'<article class="{GOOD}">{inside}</article>' if self.chance(0.6) else self.named("article", ARTICLE_NAMES, GOOD, inside)
        elif kind < 0.50:
            main = f'<main class="{GOOD}">{inside}</main>' if self.chance(0.6) else self.named("main", ARTICLE_NAMES, GOOD, inside)
        elif kind < 0.75:
            main = self.named(str(self.some(["div", "div", "section", "td"])), ARTICLE_NAMES, GOOD, inside if self.chance(0.85) else self.plain())
            main = f"<table><tr>{main}</tr></table>" if main.startswith("<td") else main
        else:
            main = f'<div class="{GOOD}">{inside if self.chance(0.85) else self.plain()}</div>'
        often = 0.4 if self.chance(0.75) else 0.06  # some pages have little beside the article
        before = [self.extra(k) for k in ("header", "menu", "notice", "ad", "form", "sidebar", "share") if self.chance(often)]
        after = [self.extra(k) for k in ("footer", "comments", "sidebar", "ad", "menu", "notice", "form", "share") if self.chance(often)]
        self.rng.shuffle(before), self.rng.shuffle(after)
        keep = int(self.rng.integers(len(before) + 1))
        body = "".join(before[keep:]) + main + "".join(after)
        if bare:
            own = "".join(before[:keep]) + body
            if root:
                return own, True
            if kind < 0.12 and self.chance(0.3):
                return own, False
            mark = f' class="{GOOD}"' if kind >= 0.12 else ""
            return f"<html><head><title>t</title></head><body{mark}>{own}" + "</body></html>" * self.chance(0.9), False
        for _ in range(int(self.rng.integers(3))):
            body = f"<div>{body}</div>" if self.chance(0.3) else self.named(str(self.some(["div", "div", "main"])), WRAPPER_NAMES, "", body)
        return f"<html><head><title>t</title></head><body>{''.join(before[:keep])}{body}" + "</body></html>" * self.chance(0.9), False


def answers(page: dom.Page, root: bool = False) -> np.ndarray:
    """Which nodes are part of the article, by the composer's marks; the marks are taken away."""
    out = np.zeros(len(page.tag))
    for i, tokens in enumerate(page.tokens):
        out[i] = 1.0 if GOOD in tokens else 0.0 if BAD in tokens else float(root) if i == 0 else out[page.parent[i]]
        page.tokens[i] = tuple(t for t in tokens if t not in (GOOD, BAD))
    return out


def train(runs: list[str], seed: int = 7, pages: int = TRAINING_PAGES) -> tuple[dict[str, int], boosting.Trees]:
    composer = Composer(runs, seed)
    composed = [composer.page() for _ in range(pages)]
    made = [dom.Page(source) for source, _ in composed]
    labels = [answers(p, root) for p, (_, root) in zip(made, composed)]
    seen = Counter(t for p in made for t in {t for tokens in p.tokens for t in tokens})
    vocabulary = {t: i for i, (t, n) in enumerate(sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:VOCABULARY]) if n > 1}
    x = np.concatenate([dom.features(p, vocabulary) for p in made])
    # nodes without text teach little, pages count alike
    weight = np.concatenate([np.where(dom.features(p, {})[:, dom.NUMERIC.index("chars")] > 0, 1.0, 0.1) for p in made])
    return vocabulary, boosting.fit(x, np.concatenate(labels), weight)


def decoded(page: dom.Page, log_odds: np.ndarray) -> np.ndarray:
    """Whether each node is part of the article in the likeliest labelling without contradictions."""
    odds = np.clip(log_odds, -8, 8)
    yes, no = -np.logaddexp(0, -odds), -np.logaddexp(0, odds)
    outside, inside, excluded = no.tolist(), yes.tolist(), no.tolist()
    parent = page.parent
    for i in range(len(parent) - 1, 0, -1):  # children come after their parents
        p = parent[i]
        outside[p] += max(outside[i], inside[i], excluded[i])
        inside[p] += max(inside[i], excluded[i])
        excluded[p] += excluded[i]
    state = [0] * len(parent)  # 0 outside, 1 article, 2 excluded
    state[0] = int(inside[0] > outside[0])  # text may stand at the root itself
    for i in range(1, len(parent)):
        above = state[parent[i]]
        if above == 2 or excluded[i] > max(inside[i], outside[i] if above == 0 else -np.inf):
            state[i] = 2
        elif above == 1 or inside[i] > outside[i]:
            state[i] = 1
    return np.array(state) == 1


def main_text(page: dom.Page, log_odds: np.ndarray) -> str:
    keep = decoded(page, log_odds)
    return " ".join(text for node, text in page.runs if keep[node])


def extracted(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", sample_pages: int = SAMPLE_PAGES, sample_runs: int = SAMPLE_RUNS, sample_chars: int = SAMPLE_CHARS) -> DataFrame:
    """Adds `text`, the article's text, and `n_chars`, its code points, to every row.

    Null and empty pages, and pages without an article, give an empty text and 0. The model is fitted on
    sentences of the `sample_pages` pages with the smallest hash of their id, of which each gives the first `sample_chars` code
    points of its first `sample_runs` blocks; with none, on a placeholder. Pages are read whole where it is applied.
    Applying it is a scan without a shuffle. Columns of the added names are replaced, others are kept.
    """
    spark = pages.sparkSession
    chosen = pages.where(F.length(html_col) > 0).select(F.xxhash64(F.lit(7), F.col(id_col).cast("string")).alias("place"), F.col(html_col).alias("html"))
    chosen = chosen.orderBy("place", F.md5(F.col("html").cast("binary"))).limit(sample_pages).withColumn("model", F.lit(0))

    def learn(table: pa.Table) -> pa.Table:
        runs = [t for source in table.sort_by("place").column("html").to_pylist() for t in (t[:sample_chars] for _, t in dom.Page(source).runs[:sample_runs])]
        return pa.table({"model": pa.array([pickle.dumps(train(runs))], pa.binary())})

    learned = chosen.groupBy("model").applyInArrow(learn, "model binary").toArrow().column("model").to_pylist()
    model = spark.sparkContext.broadcast(learned[0] if learned else pickle.dumps(train([])))
    rows = pages.drop("text", "n_chars")
    schema = rows.withColumn("text", F.lit("")).withColumn("n_chars", F.lit(0).cast("long")).schema
    at = rows.columns.index(html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, trees = pickle.loads(model.value)
        for batch in batches:
            texts: list[str] = []
            held: list[dom.Page] = []
            nodes = 0

            def flush() -> None:
                if held:
                    odds = trees.predict(np.concatenate([dom.features(p, vocabulary) for p in held]))
                    begins = 0
                    for p in held:
                        texts.append(main_text(p, odds[begins : begins + len(p.tag)]))
                        begins += len(p.tag)
                    held.clear()

            for source in batch.column(at).to_pylist():
                page = dom.Page(source or "")
                held.append(page)
                nodes += len(page.tag)
                if nodes >= 20_000:
                    flush()
                    nodes = 0
            flush()
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string()), sizes], names=schema.names)

    return rows.mapInArrow(run, schema)
