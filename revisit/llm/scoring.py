"""Subword lattice likelihood: the probability of a text under all segmentations into known pieces.

The vocabulary is an existing subword model's pieces, with every single byte besides. A word is a space
and its bytes, lower-cased; pieces don't reach over words, so a text's segmentations are those of its
words, and its marginal probability is the product of theirs and of the end's. A word's is the forward
recursion in log space over its positions: log alpha(j) = logsumexp of log alpha(i) + score(i, j).

Pieces' scores are log probabilities learned from the training texts by expectation maximisation: the
expected use of each piece over all segmentations of every distinct training word, times its count.
Words of any length take part whole. Short ones advance together, position by position; a long one goes alone
through windows, of which each hands the next the last few sums, so its arcs are never held all at once.

Words of the training texts are pieces too, each an arc over its whole lattice: a class of texts (their
language, say) uses a word with its count less a discount, and spells words with the rest of the mass. A
text's class is unknown when it is scored; its probability is the sum over all classes, each with its share
of training texts. All in all, texts' probabilities add up to one.

Words are handled once each, not once per occurrence: counts of distinct words are summed, every word's
lattice is computed in the task that holds it, and texts then look their words up. The words met most are
sent to all tasks (a bounded number); rarer ones are joined.

The most frequent classes have columns of their own. However many others there are, they are in a list of those that
use a word, with their counts. A text of n words that a class only spells has n * a + b and the words' spelling for a logarithm; each
use adds a gain. So a text meets only the classes it shares words with, and the others by their sum at its n.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import exp, fsum, log

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revisit.llm import words
from revisit.llm.common import remainder, stored

HOT_WORDS = 200_000
ROUNDS = 2
CHUNK_WORDS = 40_000
CLASSES = 8  # that have columns
DISCOUNT = 0.5
LATTICE_BYTES = words.CHUNK_BYTES  # of words that advance together
LONG_WORD = 1 << 12  # bytes; from here on a word goes alone
WINDOW = 1 << 13  # positions of a long word whose arcs are held at once
HELD_BYTES = 1 << 26  # of distinct words before a task hands them on
HELD_GAINS = 1 << 20  # of texts' words, added up or handed on at once


def vocabulary(path: str) -> list[bytes]:
    """The model's pieces in lower case that can stand in a word, and all single bytes; ascending."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out = {bytes([b]) for b in range(256)}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i).replace("▁", " ").encode()
        odd = model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
        inner = piece[1:] if piece[:1] == b" " else piece
        if not odd and piece == piece.lower() and not words.SPACE[np.frombuffer(inner, np.uint8)].any():
            out.add(piece)
    return sorted(out)


class Lattice:
    """Finds pieces at all positions of many words at once."""

    BITS = 20

    def __init__(self, pieces: list[bytes]) -> None:
        places: dict[bytes, int] = {p: i for i, p in enumerate(pieces)}
        self.longest = max(len(p) for p in pieces)
        prefixes = sorted({p[:n] for p in pieces for n in range(1, len(p) + 1)})
        buffer = np.frombuffer(b"".join(prefixes), dtype=np.uint8)
        ends = np.cumsum([len(p) for p in prefixes])
        starts = ends - [len(p) for p in prefixes]
        hashes = np.concatenate([words.spans(words.running(buffer[a:b]), np.array([0]), np.array([b - a])) for a, b in zip(starts, ends)])
        grows = {p[:-1] for p in prefixes}
        self.piece = np.array([places.get(p, -1) for p in prefixes], dtype=np.int32)
        self.grows = np.array([p in grows for p in prefixes])
        order = np.argsort(hashes)
        self.hashes, self.piece, self.grows = hashes[order], self.piece[order], self.grows[order]
        # first place among the sorted hashes for each value of their upper bits
        self.first = np.searchsorted(self.hashes >> np.uint64(64 - self.BITS), np.arange((1 << self.BITS) + 1, dtype=np.uint64)).astype(np.int32)

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Places of hashes among the prefixes; -1 where there is none."""
        top = (h >> np.uint64(64 - self.BITS)).astype(np.int64)
        at, end = self.first[top], self.first[top + 1]
        out = np.full(len(h), -1, dtype=np.int32)
        live = np.flatnonzero(at < end)
        while len(live):
            hit = self.hashes[at[live]] == h[live]
            out[live[hit]] = at[live[hit]]
            live = live[~hit]
            at[live] += 1
            live = live[at[live] < end[live]]
        return out

    def arcs(self, buffer: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For n = 1, 2, ...: positions where a piece of n bytes starts, and the pieces. `ends`: each position's word's end."""
        sums = words.running(buffer)
        live = np.arange(len(buffer))
        n = 1
        while len(live):
            found = self._find(words.spans(sums, live, live + n))
            known = found >= 0
            live, found = live[known], found[known]
            piece = self.piece[found]
            yield live[piece >= 0], piece[piece >= 0]
            live = live[self.grows[found]]
            n += 1
            live = live[live + n <= ends[live]]


def _laid_out(group: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    buffer = np.frombuffer(b"".join([b" " + w for w in group]), dtype=np.uint8)
    sizes = np.array([len(w) + 1 for w in group])
    ends = np.cumsum(sizes)
    return buffer, ends - sizes, ends


def _by_place(starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Positions grouped by their distance from their word's start: words advance together."""
    place = np.arange(ends[-1]) - np.repeat(starts, ends - starts)
    order = np.argsort(place, kind="stable")
    return np.split(order, np.cumsum(np.bincount(place))[:-1])


def forward(lattice: Lattice, score: np.ndarray, group: list[bytes]) -> tuple[np.ndarray, list, np.ndarray, np.ndarray, list]:
    """Log alpha after each position, for words laid out one after the other; and the arcs."""
    buffer, starts, ends = _laid_out(group)
    word_end = np.repeat(ends, ends - starts)
    arcs = [np.full(len(buffer), -1, dtype=np.int32)]
    for n, (at, piece) in enumerate(lattice.arcs(buffer, word_end), 1):
        own = np.full(len(buffer), -1, dtype=np.int32)
        own[at + n - 1] = piece  # by the arc's last position
        arcs.append(own)
    padded = np.append(score, -np.inf)
    alpha = np.full(len(buffer), -np.inf)
    columns = _by_place(starts, ends)
    for depth, at in enumerate(columns):
        total = padded[arcs[depth + 1][at]] if depth + 1 < len(arcs) else np.full(len(at), -np.inf)
        for n in range(1, min(depth + 1, len(arcs))):
            piece = arcs[n][at]
            some = np.flatnonzero(piece >= 0)
            if len(some):
                total[some] = np.logaddexp(total[some], alpha[at[some] - n] + score[piece[some]])
        alpha[at] = total
    return alpha, arcs, starts, ends, columns


def _groups(found: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of words, bounded in words and bytes. Callers sort by length."""
    ends = np.cumsum([len(w) + 1 for w in found])
    at = 0
    while at < len(found):
        fit = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + LATTICE_BYTES, "right"))
        to = max(at + 1, min(at + CHUNK_WORDS, fit))
        yield at, found[at:to]
        at = to


def _by_length(found: list[bytes]) -> tuple[list[int], list[int]]:
    """Places of the words that go alone, and of the others, longest first."""
    order = sorted(range(len(found)), key=lambda i: -len(found[i]))
    alone = sum(len(w) >= LONG_WORD for w in found)
    return order[:alone], order[alone:]


def _window(lattice: Lattice, word: bytes, a: int, b: int, back: bool) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Lengths and pieces of the arcs that end in a + 1 to b, or, going back, start in b - 1 down to a; and where each position's begin."""
    low, high = (a, min(len(word), b + lattice.longest - 1)) if back else (max(0, a + 1 - lattice.longest), b)
    buffer = np.frombuffer(word, dtype=np.uint8, count=high - low, offset=low)
    place, length, piece = [], [], []
    for n, (at, own) in enumerate(lattice.arcs(buffer, np.full(len(buffer), len(buffer))), 1):
        turn = b - 1 - (at + low) if back else at + low + n - (a + 1)
        mine = (turn >= 0) & (turn < b - a)
        place.append(turn[mine]), piece.append(own[mine]), length.append(np.full(mine.sum(), n))
    place = np.concatenate(place)
    order = np.argsort(place, kind="stable")
    return np.concatenate(length)[order], np.concatenate(piece)[order], np.searchsorted(place[order], np.arange(b - a + 1)).tolist()


def _advance(sums: list[float], length: np.ndarray, weight: np.ndarray, cuts: list[int]) -> list[float]:
    """The log sums given, last one next to the window, and those of the window's positions after them."""
    out, arcs = list(sums), list(zip(length.tolist(), weight.tolist()))
    for i, j in zip(cuts, cuts[1:]):
        terms = [out[-n] + w for n, w in arcs[i:j]]
        top = max(terms)
        out.append(top + log(sum([exp(t - top) for t in terms])) if j - i > 1 else top)
    return out


def _handed(sums: list[float], n: int) -> tuple[list[float], float]:
    """The last n sums less the last one, and that: sums stay small, so that long words lose no digits."""
    return [x - sums[-1] for x in sums[-n:]], sums[-1]


def _long_forward(lattice: Lattice, score: np.ndarray, word: bytes) -> tuple[list[list[float]], float]:
    """What each window of a word (with its space) is handed, and log alpha at the end: forward() for one word."""
    handed, sums, moved = [], [0.0], []
    for a in range(0, len(word), WINDOW):
        handed.append(sums)
        length, piece, cuts = _window(lattice, word, a, min(len(word), a + WINDOW), False)
        sums, by = _handed(_advance(sums, length, score[piece], cuts), lattice.longest)
        moved.append(by)
    return handed, fsum(moved)


def _long_expected(lattice: Lattice, score: np.ndarray, word: bytes) -> np.ndarray:
    """Expected uses of each piece in a word (with its space).

    Windows are taken from the last to the first and alpha is made once more in each. Every segmentation has
    one arc over a window's first byte, so those arcs' sum is the whole, against which the others are measured.
    """
    out = np.zeros(len(score))
    rest = [0.0]
    for a, sums in zip(reversed(range(0, len(word), WINDOW)), reversed(_long_forward(lattice, score, word)[0])):
        b, low = min(len(word), a + WINDOW), a + 1 - len(sums)
        length, piece, cuts = _window(lattice, word, a, b, False)
        alpha = np.array(_advance(sums, length, score[piece], cuts))  # from low on
        length, piece, cuts = _window(lattice, word, a, b, True)
        rest = _advance(rest, length, score[piece], cuts)
        beta = np.array(rest[::-1])  # from a on
        start = b - 1 - np.repeat(np.arange(b - a), np.diff(cuts))
        use = alpha[start - low] + score[piece] + beta[start + length - a]
        length, over, cuts = _window(lattice, word, low, a + 1, True)
        first = a - np.repeat(np.arange(a + 1 - low), np.diff(cuts))
        mine = first + length > a
        length, over, first = length[mine], over[mine], first[mine]
        whole = np.logaddexp.reduce(alpha[first - low] + score[over] + beta[first + length - a])
        out += np.bincount(piece, np.exp(use - whole), minlength=len(out))
        rest, _ = _handed(rest, lattice.longest)
    return out


def log_probabilities(lattice: Lattice, score: np.ndarray, found: list[bytes]) -> np.ndarray:
    """Natural log of each word's marginal probability."""
    out = np.zeros(len(found))
    alone, order = _by_length(found)
    for i in alone:
        out[i] = _long_forward(lattice, score, b" " + found[i])[1]
    for at, group in _groups([found[i] for i in order]):
        alpha, _, _, ends, _ = forward(lattice, score, group)
        out[[order[i] for i in range(at, at + len(group))]] = alpha[ends - 1]
    return out


def expected(lattice: Lattice, score: np.ndarray, found: list[bytes], counts: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all segmentations of the words, times their counts."""
    out = np.zeros(len(score))
    alone, order = _by_length(found)
    for i in alone:
        out += _long_expected(lattice, score, b" " + found[i]) * counts[i]
    for first, group in _groups([found[i] for i in order]):
        weight = counts[[order[i] for i in range(first, first + len(group))]]
        alpha, arcs, starts, ends, columns = forward(lattice, score, group)
        owner = np.repeat(np.arange(len(group)), ends - starts)
        beta = np.full(len(alpha), -np.inf)  # log probability of the rest of the word
        beta[ends - 1] = 0.0
        whole = alpha[ends - 1]
        for depth in range(len(columns) - 1, -1, -1):
            at = columns[depth]
            for n in range(1, min(depth + 2, len(arcs))):
                piece = arcs[n][at]
                some = np.flatnonzero(piece >= 0)
                if not len(some):
                    continue
                end, own = at[some], piece[some]
                before = alpha[end - n] if n <= depth else np.zeros(len(some))
                out += np.bincount(own, np.exp(before + score[own] + beta[end] - whole[owner[end]]) * weight[owner[end]], minlength=len(out))
                if n <= depth:
                    beta[end - n] = np.logaddexp(beta[end - n], score[own] + beta[end])
    return out


@lru_cache(maxsize=1)
def prepared(pieces: tuple[bytes, ...]) -> Lattice:
    return Lattice(list(pieces))


def _words(texts: list[bytes | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray, bytes, np.ndarray, np.ndarray]]:
    """Runs of texts: the first one's index, word hashes, offsets per text, and the words' bytes and bounds."""
    for first, group in words.chunked(texts):
        for part in words.parts(group[0].lower()) if len(group) == 1 else [b" ".join(group).lower()]:
            buffer = np.frombuffer(part, dtype=np.uint8)
            starts, ends = words.bounds(buffer)
            hashes = words.long_hashes(part, starts, ends) if len(part) > words.CHUNK_BYTES + 1 else words.spans(words.running(buffer), starts, ends)
            at = np.cumsum([0, *(len(t) + 1 for t in group)]) if len(group) > 1 else np.array([0, len(part) + 1])
            yield first, hashes, np.searchsorted(starts, at), part, starts, ends


def _counts(docs: DataFrame) -> DataFrame:
    """Distinct words with their counts by class (-1: not for training). Tasks sum up before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots: dict[tuple[int, int], int] = {}
        held: list[tuple[int, int, bytes]] = []
        counts: list[int] = []
        held_bytes = 0

        def out() -> pa.RecordBatch:
            h, k, w = zip(*held)
            batch = pa.RecordBatch.from_arrays([pa.array(np.array(h, dtype=np.uint64).view(np.int64)), pa.array(k, pa.int64()), pa.array(w, pa.binary()), pa.array(counts, pa.int64())], names=["hash", "class", "word", "n"])
            slots.clear(), held.clear(), counts.clear()
            return batch

        for batch in batches:
            classes = batch.column(1).to_numpy()
            for first, hashes, offsets, part, starts, ends in _words(words.as_bytes(batch.column(0))):
                owner = np.repeat(classes[first : first + len(offsets) - 1], np.diff(offsets))
                for k in np.unique(owner):
                    mine = np.flatnonzero(owner == k)
                    h, index, n = np.unique(hashes[mine], return_index=True, return_counts=True)
                    at = mine[index]
                    for x, a, b, c in zip(h.tolist(), starts[at].tolist(), ends[at].tolist(), n.tolist()):
                        slot = slots.setdefault((x, int(k)), len(counts))
                        if slot == len(counts):
                            held.append((x, int(k), part[a:b]))
                            counts.append(c)
                            held_bytes += b - a
                        else:
                            counts[slot] += c
                    if len(counts) >= 300_000 or held_bytes >= HELD_BYTES:
                        yield out()
                        held_bytes = 0
        if counts:
            yield out()

    rows = docs.mapInArrow(run, "hash long, class long, word binary, n long")
    return rows.groupBy("hash", "class").agg(F.first("word").alias("word"), F.sum("n").alias("n"))


def _log_sum(rows: DataFrame, key: str, x: str) -> DataFrame:
    """The logarithm of the sum of exp(x) for each key, as x."""
    top = rows.withColumn("top", F.max(x).over(Window.partitionBy(key)))
    return top.groupBy(key).agg((F.first("top") + F.log(F.sum(F.exp(F.col(x) - F.col("top"))))).alias(x))


def _spelling(texts: DataFrame, known: DataFrame, n_texts: int) -> DataFrame:
    """Classes with a and b: of n words that it only spells, a class has the log probability n * a + b and their spelling's."""
    sizes = texts.groupBy("class").agg(F.count("*").alias("texts"))
    sums = known.select(F.explode("others").alias("x")).groupBy("x.class").agg(F.sum("x.n").alias("used"), F.count("*").alias("v"))
    own = F.col("used") + F.col("texts")
    half = F.lit(log(0.5))  # of a class without words
    return sizes.join(sums, "class", "left").select(
        "class", "v", F.coalesce(F.log(F.col("v") * DISCOUNT / own), half).alias("a"),
        (F.coalesce(F.log(F.col("texts") / own), half) + F.log(F.col("texts") / F.lit(float(n_texts)))).alias("b"),
    )


def _gains(rows: DataFrame, spelling: DataFrame) -> DataFrame:
    """A row per class that uses a row's word, with what its use adds to the logarithm of spelling the word."""
    pairs = rows.withColumn("x", F.explode("others")).withColumn("class", F.col("x.class")).join(spelling.select("class", "v"), "class")
    x = F.log((F.col("x.n") - DISCOUNT) / (F.col("v") * DISCOUNT)) - F.col("q")
    return pairs.withColumn("gain", F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))).drop("x", "v", "others")


def _gained(owner: np.ndarray, at: np.ndarray, first: np.ndarray, class_: np.ndarray, gain: np.ndarray, n: int, n_classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets of n texts, classes and sums of gains. Texts' words are given by owner and place; a place's classes start at first."""
    key, times = np.unique(owner * (len(first) - 1) + at, return_counts=True)
    owner, at = np.divmod(key, len(first) - 1) if len(key) else (key, key)
    many = first[at + 1] - first[at]
    ends = np.cumsum(many)
    keys, sums, i = np.zeros(0, dtype=np.int64), np.zeros(0), 0
    while i < len(at):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + HELD_GAINS, "right")))
        of = words.ranges(first[at[i:j]], many[i:j])
        key = np.concatenate((keys, np.repeat(owner[i:j], many[i:j]) * n_classes + class_[of]))
        sums = np.concatenate((sums, np.repeat(times[i:j], many[i:j]) * gain[of]))
        keys, place = np.unique(key, return_inverse=True)
        sums, i = np.bincount(place, weights=sums, minlength=len(keys)), j
    return np.searchsorted(keys, np.arange(n + 1) * n_classes), keys % max(1, n_classes), sums


def _slices(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    return (batch.slice(i, max(1, n)) for batch in batches for i in range(0, batch.num_rows, max(1, n)))


def scores(
    docs: DataFrame, training: Column, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", class_col: str | None = "lang",
    rounds: int = ROUNDS, hot_words: int = HOT_WORDS, classes: int = CLASSES,
) -> DataFrame:
    """Every row's log10 probability by the model and by a smoothed word unigram, both of the training rows.

    Tokens are words and then one end. Returns id_col, held_out, n_tokens, n_known (tokens met in training),
    train_tokens, base_score and score. A null or empty text is an end alone. Rows that repeat an id are
    texts of their own, null ids are kept, a null class is one class. Scores don't depend on `hot_words` and
    `classes` (at least 1), which say how many words are sent to all tasks and how many classes have columns.
    Without training rows all tokens are unknown and every text has the one class's spelling
    probability. An empty table gives an empty result. Other columns play no part.
    """
    spark = docs.sparkSession
    pieces = vocabulary(vocabulary_path)
    kind = F.col(class_col).cast("string") if class_col else F.lit("")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), kind.alias("kind"), F.coalesce(training, F.lit(False)).alias("train"))
    sizes = rows.where("train").groupBy("kind").count().orderBy(F.desc("count"), F.col("kind").asc_nulls_last()).limit(classes).collect()
    place = F.shiftrightunsigned(F.xxhash64("kind"), 2) + len(sizes)  # each of the others
    for k, row in reversed(list(enumerate(sizes))):
        place = F.when(F.col("kind").eqNullSafe(F.lit(row["kind"])), k).otherwise(place)
    rows = rows.withColumn("class", F.when(F.col("train"), place).otherwise(-1).cast("long"))
    texts = {k: row["count"] for k, row in enumerate(sizes)}
    n_texts = rows.where("train").count()
    others = n_texts > sum(texts.values())

    counted = _counts(rows.select("text", "class"))
    n_classes = max(1, len(sizes))
    by_class = [F.coalesce(F.sum(F.when(F.col("class") == k, F.col("n"))), F.lit(0)).alias(f"c{k}") for k in range(n_classes)]
    by_class.append(F.coalesce(F.sum(F.when(F.col("class") >= 0, F.col("n"))), F.lit(0)).alias("c"))
    if others:
        by_class.append(F.collect_list(F.when(F.col("class") >= n_classes, F.struct("class", "n"))).alias("others"))
    table = stored(counted.groupBy("hash").agg(F.first("word").alias("word"), *by_class))
    per = table.agg(*[F.sum(f"c{k}").alias(f"n{k}") for k in range(n_classes)], *[F.sum((F.col(f"c{k}") > 0).cast("long")).alias(f"v{k}") for k in range(n_classes)], F.sum("c").alias("n"), F.sum((F.col("c") > 0).cast("long")).alias("v")).first()
    tokens = (per["n"] or 0) + n_texts
    distinct = (per["v"] or 0) + (1 if n_texts else 0)

    # expectation maximisation over distinct training words; a step's sums are a row per piece
    fixed = tuple(pieces)
    score = np.full(len(pieces), -np.log(len(pieces)))
    for _ in range(rounds):
        now = score

        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lattice, total = prepared(fixed), np.zeros(len(fixed))
            for batch in batches:
                total += expected(lattice, now, batch.column(0).to_pylist(), batch.column(1).to_numpy().astype(float))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(fixed), dtype=np.int32)), pa.array(total)], names=["piece", "n"])

        summed = table.where("c > 0").select("word", "c").mapInArrow(step, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).toArrow()
        uses = np.zeros(len(pieces))
        uses[summed.column("piece").to_numpy()] = summed.column("n").to_numpy()
        score = np.log((uses + 0.01) / (uses.sum() + 0.01 * len(pieces)))
    final = score

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = prepared(fixed)
        for batch in batches:
            q = log_probabilities(lattice, final, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(q)], names=names)

    names = ["hash", *[f"c{k}" for k in range(n_classes)], "c", *["others"] * others, "q"]
    kinds = {"q": "double", "others": "array<struct<class: long, n: long>>"}
    schema = ", ".join(f"{n} {kinds.get(n, 'long')}" for n in names)
    known = stored(table.select("hash", "word", *names[1:-1]).mapInArrow(spell, schema))

    # a class's natural log probability of a word, of the end, and of the class itself
    live = list(range(n_classes))
    texts = texts or {0: 1}
    used = {k: per[f"n{k}"] or 0 for k in live}
    rest = {k: (per[f"v{k}"] or 0) * DISCOUNT / used[k] if used[k] else 1.0 for k in live}
    word_share = {k: used[k] / (used[k] + texts[k]) if used[k] else 0.5 for k in live}
    end_log = {k: float(np.log1p(-word_share[k])) for k in live}
    prior_log = {k: float(np.log(texts[k] / max(1, n_texts))) for k in live}

    # the words met most, a bounded number, go to every task
    most = known.orderBy(F.desc("c"), "hash")
    hot = most.limit(hot_words).select(*[F.size(n).alias(n) if n == "others" else n for n in names]).toArrow()
    if others:
        # their gains go with them, of a bounded number too; words beyond are joined as rare ones
        hot = hot.slice(0, int(np.searchsorted(np.cumsum(hot.column("others").to_numpy()), classes * hot_words, "right")))
        spelling = stored(_spelling(rows.where(F.col("class") >= n_classes), known, n_texts))
        sent = _gains(most.limit(len(hot)).select("hash", "q", "others"), spelling).select("hash", "class", "gain").toArrow()
    order = np.argsort(hot.column("hash").to_numpy().view(np.uint64))
    hot_hash = hot.column("hash").to_numpy().view(np.uint64)[order]
    hot_c, hot_q = hot.column("c").to_numpy()[order], hot.column("q").to_numpy()[order]
    hot_log = np.stack([_word_log(hot.column(f"c{k}").to_numpy()[order], hot_q, used[k], rest[k], word_share[k]) for k in live])
    hot_base = np.log10(hot_c + 1.0)
    hot_gains = None
    if others:
        hot_log = np.concatenate((hot_log, [hot_q]))
        whose = np.searchsorted(hot_hash, sent.column("hash").to_numpy().view(np.uint64))
        named, class_ = np.unique(sent.column("class").to_numpy(), return_inverse=True)
        by_word = np.argsort(whose, kind="stable")
        hot_gains = named, np.searchsorted(whose[by_word], np.arange(len(hot_hash) + 1)), class_[by_word], sent.column("gain").to_numpy()[by_word]
    shared = spark.sparkContext.broadcast((hot_hash, hot_c, hot_log, hot_base, hot_gains))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hash_, c, logs, base, own_gains = shared.value
        row, part = 0, TaskContext.get().partitionId() << 36
        for batch in _slices(batches, HELD_GAINS // max(1, len(own_gains[0]) if own_gains else 1)):
            n = batch.num_rows
            out = {"n": np.zeros(n, np.int64), "known": np.zeros(n, np.int64), "base": np.zeros(n), "logs": np.zeros((len(logs), n))}
            rare: list[list[np.ndarray]] = [[] for _ in range(n)]
            met: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for first, hashes, offsets in words.hashed(words.as_bytes(batch.column(1))):
                owner = first + np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
                at = np.searchsorted(hash_, hashes)
                at[at == len(hash_)] = 0
                hit = hash_[at] == hashes if len(hash_) else np.zeros(len(hashes), dtype=bool)
                out["n"] += np.bincount(owner, minlength=n)
                mine, at = owner[hit], at[hit]
                out["known"] += np.bincount(mine, weights=c[at] > 0, minlength=n).astype(np.int64)
                out["base"] += np.bincount(mine, weights=base[at], minlength=n)
                for k in range(len(logs)):
                    out["logs"][k] += np.bincount(mine, weights=logs[k][at], minlength=n)
                if own_gains:
                    met.append(_gained(mine - first, at, *own_gains[1:], len(offsets) - 1, len(own_gains[0])))
                left, whose = hashes[~hit], owner[~hit]
                cuts = np.searchsorted(whose, np.arange(first, first + len(offsets)))
                for i in range(len(offsets) - 1):
                    if cuts[i] < cuts[i + 1]:
                        rare[first + i].append(left[cuts[i] : cuts[i + 1]])
            flat = [np.concatenate(x).view(np.int64) if x else np.zeros(0, dtype=np.int64) for x in rare]
            lists = [pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum([len(x) for x in flat]))).astype(np.int32)), pa.array(np.concatenate([*flat, np.zeros(0, np.int64)])))]
            if own_gains:
                ends = pa.array(np.concatenate(([0], np.cumsum(np.concatenate([*[np.diff(x[0]) for x in met], np.zeros(0, np.int64)])))).astype(np.int32))
                lists.append(pa.ListArray.from_arrays(ends, pa.array(own_gains[0][np.concatenate([*[x[1] for x in met], np.zeros(0, np.int64)])])))
                lists.append(pa.ListArray.from_arrays(ends, pa.array(np.concatenate([*[x[2] for x in met], np.zeros(0)]))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + n) + part), batch.column(0), batch.column(2), pa.array(out["n"] + 1), pa.array(out["known"]), pa.array(out["base"]), *[pa.array(x) for x in out["logs"]], *lists],
                names=got)
            row += n

    sums = [f"s{k}" for k in live] + ["sq"] * others
    got = ["row", "id", "train", "n_tokens", "known", "base", *sums, "rare", *["class", "gain"] * others]
    id_type = rows.schema["id"].dataType.simpleString()
    first_pass = stored(rows.select("id", "text", "train").mapInArrow(look_up, f"row long, id {id_type}, train boolean, n_tokens long, known long, base double, {', '.join(f'{s} double' for s in sums)}, rare array<long>{', class array<long>, gain array<double>' * others}"))

    spelled = [F.log((F.greatest(F.col(f"c{k}") - DISCOUNT, F.lit(0.0)) / float(used[k]) if used[k] else F.lit(0.0)) + F.lit(rest[k]) * F.exp("q")) + F.lit(float(np.log(word_share[k]))) for k in live]
    # a word not met by the class is spelled; its logarithm needs no sum
    spelled = [F.when(F.col(f"c{k}") == 0, F.col("q") + F.lit(float(np.log(rest[k]) + np.log(word_share[k])))).otherwise(e) for k, e in zip(live, spelled)] + [F.col("q")] * others
    rare_words = first_pass.select("row", "n_tokens", F.explode("rare").alias("hash")).groupBy("row", *["n_tokens"] * others, "hash").count()
    rare = (
        rare_words.join(known, "hash").groupBy("row")
        .agg(F.sum(F.when(F.col("c") > 0, F.col("count")).otherwise(0)).alias("rare_known"), F.sum(F.col("count") * F.log10(F.col("c") + F.lit(1.0))).alias("rare_base"),
             *[F.sum(F.col("count") * e).alias(f"r{k}") for k, e in zip([*live, "q"], spelled)])
    )
    zero = F.lit(0.0)
    totals = [F.col(f"s{k}") + F.coalesce(F.col(f"r{k}"), zero) + F.lit(end_log[k] + prior_log[k]) for k in live]
    found = first_pass.drop("rare", "class", "gain").join(rare, "row", "left")
    if others:
        g, spelt = F.col("gain"), F.col("a") * (F.col("n_tokens") - 1) + F.col("b")
        met = first_pass.select("row", "n_tokens", F.explode(F.arrays_zip("class", "gain")).alias("x")).select("row", "n_tokens", "x.class", "x.gain")
        met = met.unionByName(_gains(rare_words.join(known.select("hash", "q", "others"), "hash"), spelling).select("row", "n_tokens", "class", (F.col("count") * g).alias("gain")))
        met = met.repartition("row").groupBy("row", "n_tokens", "class").agg(F.sum("gain").alias("gain")).join(spelling, "class")
        # exp(spelt + gain) less exp(spelt), which the sum over all classes holds
        more = spelt + F.when(g < 30, F.log(F.expm1(g))).otherwise(g + F.log1p(-F.exp(-g)))
        met = _log_sum(met.select("row", more.alias("met")), "row", "met")
        all_spelt = _log_sum(first_pass.select("n_tokens").distinct().crossJoin(spelling).select("n_tokens", spelt.alias("spelt")), "n_tokens", "spelt")
        found = found.join(all_spelt, "n_tokens").join(met, "row", "left")
        totals += [F.col("sq") + F.coalesce(F.col("rq"), zero) + x for x in (F.col("spelt"), F.coalesce(F.col("met"), F.lit(float("-inf"))))]
    return (
        found
        .withColumn("totals", F.array(*totals)).withColumn("top", F.array_max("totals"))
        .select(
            F.col("id").alias(id_col), (~F.col("train")).alias("held_out"), "n_tokens",
            (F.col("known") + F.coalesce("rare_known", F.lit(0)) + F.lit(1 if n_texts else 0)).cast("long").alias("n_known"),
            F.lit(tokens).cast("long").alias("train_tokens"),
            (F.col("base") + F.coalesce("rare_base", zero) + F.lit(float(np.log10(n_texts + 1.0))) - F.col("n_tokens") * F.lit(float(np.log10(tokens + distinct + 1.0)))).alias("base_score"),
            ((F.col("top") + F.log(F.aggregate("totals", zero, lambda a, x: a + F.exp(x - F.col("top"))))) / F.lit(float(np.log(10.0)))).alias("score"),
        )
    )


def _word_log(c: np.ndarray, q: np.ndarray, used: int, rest: float, share: float) -> np.ndarray:
    """A class's natural log probability of words with counts c and spelling log probabilities q."""
    with np.errstate(divide="ignore"):
        whole = np.log(np.maximum(c - DISCOUNT, 0) / used) if used else np.full(len(c), -np.inf)
    return np.logaddexp(whole, q + np.log(rest)) + np.log(share)


def documents_scored(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", class_col: str | None = "lang") -> DataFrame:
    """scores() that learns from rows whose crc32(id) modulo 7 is not 2."""
    return scores(docs, remainder(F.col(id_col), 7) != 2, vocabulary_path, id_col, text_col, class_col)
