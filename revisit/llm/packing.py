"""Vector bin packing of tokenised examples into training sequences.

An example's demand is a vector: tokens, one segment, loss-bearing tokens. A sequence has a limit in each.
The dot-product heuristic fills one sequence at a time: of the examples that fit, the one whose demand has
the largest dot product with what is left comes next, both in shares of the limits. When none fits whole,
the one with the largest product is cut so that the sequence becomes full. A sequence that can't become
full (no segments or loss tokens left, or no examples) is cut into lengths that are powers of two, which
need no padding. So nothing is padded, dropped or truncated, and every id lies in one piece.

Every task packs the rows it reads, window by window; there is no shuffle, and a task that runs again on
the same input makes the same sequences.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH = 1024
SEGMENTS = 32
WINDOW_ROWS = 4096
WINDOW_CHARS = 1 << 24
SLICE = 1 << 20
END_ID = 0
SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")

#: How byte-level tokenizers split text (fixed value).
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of_char() -> dict[str, int]:
    """The printable characters by which byte-level vocabularies write bytes."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def encoder(path: str) -> tuple[Callable[[str], list[int]], bool]:
    """Ids of a text without special tokens, by the tokenizer file at `path`; whether it is byte-level BPE.

    A byte-level BPE whose ids ascend in the order of its merges gives the same ids when pairs are merged
    by the smallest id, which a faster library does.
    """
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    model, split = described["model"], described.get("pre_tokenizer") or {}
    vocab = model.get("vocab")
    if model["type"] == "BPE" and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space") and not described.get("normalizer"):
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        ids = [vocab[m] for m in merged]
        if all(a < b for a, b in zip(ids, ids[1:])) and len(vocab) == len(ids) + 256:
            import tiktoken

            byte = _byte_of_char()
            ranks = {bytes(byte[c] for c in token): i for token, i in vocab.items()}
            return tiktoken.Encoding("vocabulary", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary, True
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids, False


def slices(text: str) -> Iterator[str]:
    """A long text in parts. A byte-level split always begins a token at a space between two characters
    that are no white space, so the parts' ids one after the other are the text's."""
    at = 0
    while len(text) - at > 2 * SLICE:
        cut = SAFE_CUT.search(text, at + SLICE)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


class Ids:
    """Ids of whole texts, each followed by the end id."""

    def __init__(self, path: str) -> None:
        self.encode, self.in_parts = encoder(path)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and each text's first place among them (one more than texts)."""
        out, sizes = array("I"), []
        for text in texts:
            before = len(out)
            for part in slices(text) if self.in_parts else [text]:
                out.extend(array("I", self.encode(part)))
            out.append(END_ID)
            sizes.append(len(out) - before)
        return np.frombuffer(out, dtype=np.uint32), np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))


def powers_of_two(length: int) -> list[int]:
    return [1 << bit for bit in range(length.bit_length() - 1, -1, -1) if length >> bit & 1]


def closed(pieces: list[tuple[int, int, int]], length: int) -> Iterator[list[tuple[int, int, int]]]:
    """A sequence's pieces (example, start, tokens) as sequences that need no padding."""
    total = sum(p[2] for p in pieces)
    if total == length or total & (total - 1) == 0:
        if total:
            yield pieces
        return
    rest = list(reversed(pieces))
    for size in powers_of_two(total):
        own = []
        while size:
            example, start, tokens = rest.pop()
            use = min(size, tokens)
            own.append((example, start, use))
            size -= use
            if use < tokens:
                rest.append((example, start + use, tokens - use))
        yield own


def pack(tokens: np.ndarray, prompts: np.ndarray, length: int, segments: int, loss: int) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences of pieces (example, start, tokens); an example's first `prompts` tokens bear no loss."""
    start = np.zeros(len(tokens), dtype=np.int64)
    open_ = np.ones(len(tokens), dtype=bool) & (tokens > 0)
    if loss >= length:  # a full sequence from one example breaks no limit
        for i in np.flatnonzero(tokens >= length):
            for at in range(0, int(tokens[i]) - length + 1, length):
                yield [(int(i), at, length)]
            start[i] = tokens[i] // length * length
        open_ &= start < tokens
    items = np.flatnonzero(open_)
    left = (tokens - start)[items]
    bearing = np.maximum(0, tokens - np.maximum(prompts, start))[items]

    def fits(k: int, room: int, room_loss: int) -> int:
        """How many of the item's next tokens fit."""
        free = int(left[k] - bearing[k])
        return int(min(left[k], room, free + room_loss))

    while len(items):
        pieces: list[tuple[int, int, int]] = []
        room, room_loss = length, loss
        while room and len(pieces) < segments and len(items):
            product = left * (room / length**2) + bearing * (room_loss / max(loss, 1) ** 2)
            last = len(pieces) == segments - 1
            whole = (left <= room) & (bearing <= room_loss)
            if last:  # only what fills the sequence, if there is such an example
                filling = np.minimum(left, left - bearing + room_loss) >= room
                k = int(np.argmax(np.where(filling, product, -1))) if filling.any() else int(np.argmax(product * whole)) if whole.any() else int(np.argmax(product))
            elif whole.any():
                k = int(np.argmax(np.where(whole, product, -1)))
            else:
                k = int(np.argmax(product))
            use = fits(k, room, room_loss)
            if use <= 0:
                break
            i = int(items[k])
            pieces.append((i, int(start[i]), use))
            lost = max(0, use - int(left[k] - bearing[k]))
            room, room_loss = room - use, room_loss - lost
            start[i] += use
            left[k] -= use
            bearing[k] -= lost
            if not left[k]:
                keep = np.ones(len(items), dtype=bool)
                keep[k] = False
                items, left, bearing = items[keep], left[keep], bearing[keep]
        yield from closed(pieces, length)


SCHEMA = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"


def packed(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", prompt_col: str | None = None,
    length: int = LENGTH, segments: int = SEGMENTS, loss: int = LENGTH, with_ids: bool = False,
) -> DataFrame:
    """One row per piece: where it lies in its example and in its sequence, and a checksum of its ids.

    `tokenizer` is the path of a tokenizer file; `length` a power of two; `loss` the most loss-bearing
    tokens of a sequence, at least 1. With a prompt column, the prompt's ids come first and bear no loss;
    else all ids bear loss. Every example ends with id 0. Null texts and prompts count as empty (the end
    id alone), repeated ids are examples of their own, null ids are kept. With `with_ids`, rows carry the
    piece's ids too. Other columns play no part. An empty table gives an empty result.
    """
    if length < 1 or length & (length - 1) or segments < 1 or loss < 1:
        raise ValueError("length must be a power of two, segments and loss at least 1")
    prompt = F.coalesce(F.col(prompt_col), F.lit("")) if prompt_col else F.lit("")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), prompt.alias("prompt"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"`{id_col}` {kind}, {SCHEMA}" + (", ids array<long>" if with_ids else "")
    names = [id_col, *[part.split()[0] for part in SCHEMA.split(", ")], *(["ids"] if with_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Ids(tokenizer)
        sequence = TaskContext.get().partitionId() << 40

        def window(keys: list, texts: list[str], heads: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            ids, offsets = tool(texts)
            first = np.zeros(len(keys), dtype=np.int64)
            if any(heads):  # a prompt's ids without its end id, before the text's
                head_ids, head_offsets = tool(heads)
                first = np.diff(head_offsets) - 1
                ids = np.concatenate([x for i in range(len(keys)) for x in (head_ids[head_offsets[i] : head_offsets[i + 1] - 1], ids[offsets[i] : offsets[i + 1]])])
                offsets = offsets + np.concatenate(([0], np.cumsum(first)))
            sizes = np.diff(offsets)
            out: list[tuple] = []
            for pieces in pack(sizes, first, length, segments, loss):
                offset = 0
                for i, start, use in pieces:
                    at = int(offsets[i]) + start
                    own = ids[at : at + use]
                    row = (keys[i], start, use, zlib.crc32(own), int(sizes[i]), sequence, offset, max(0, start + use - max(start, int(first[i]))))
                    out.append((*row, own.astype(np.int64)) if with_ids else row)
                    offset += use
                sequence += 1
            for at in range(0, len(out), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, kind_) for c, kind_ in zip(zip(*out[at : at + 20_000]), types)], names=names)

        for batch in batches:
            types = [batch.schema.field(0).type, *[pa.int64()] * 7, *([pa.list_(pa.int64())] if with_ids else [])]
            held: tuple[list, list, list] = ([], [], [])
            many = 0
            for key, text, head in zip(*(c.to_pylist() for c in batch.columns)):
                if held[0] and (many + len(text) + len(head) > WINDOW_CHARS or len(held[0]) >= WINDOW_ROWS):
                    yield from window(*held, types)
                    held, many = ([], [], []), 0
                held[0].append(key), held[1].append(text), held[2].append(head)
                many += len(text) + len(head)
            if held[0]:
                yield from window(*held, types)

    return rows.mapInArrow(run, schema)
