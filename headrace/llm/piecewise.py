"""Fingerprints of texts by context-triggered piecewise hashing, and their likeness by edit distance."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headrace.llm.ordered import in_order
from headrace.llm.tables import Workspace, ship_library
from headrace.llm.words import mix

# Bytes that the rolling hash sees, most pieces of a signature, the least power of two as block size.
WINDOW = 7
PIECES = 64
LEAST = 2

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_SYMBOLS = np.frombuffer(ALPHABET.encode(), np.uint8)
_CODES = np.full(256, PIECES, np.uint8)
_CODES[_SYMBOLS] = np.arange(PIECES, dtype=np.uint8)

# Bytes worked through at once, and rows compared at once: or fewer, once their texts make up so many characters.
_CHUNK = 1 << 20
_ROWS, _CHARS = 512, 4 << 20

# A run of equal pieces this long, or a third of the shorter signature, must be in both.
_RUN = 7


def _rolling(data: np.ndarray) -> np.ndarray:
    """A hash of each byte and the six before it; `data` begins with six bytes that get none."""
    data, n = data.astype(np.uint32), len(data) - WINDOW + 1
    sums, shifted = np.zeros(n, np.uint32), np.zeros(n, np.uint32)
    for age in range(WINDOW):
        seen = data[WINDOW - 1 - age:WINDOW - 1 - age + n]
        sums += seen * np.uint32(WINDOW + 1 - age)
        shifted ^= seen << np.uint32(5 * age)
    x = (sums + shifted) * np.uint32(0x9E3779B1)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x85EBCA6B)
    return x ^ (x >> np.uint32(13))


def _triggers(data: np.ndarray, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Levels of the boundaries from `floor` up, the hash sums of all bytes up to each, and that of the whole text.

    A boundary lies after a byte whose rolling hash ends in as many zero bits as its level, 32 at most.
    """
    levels, sums, total = [], [], 0
    padded = np.concatenate([np.zeros(WINDOW - 1, np.uint8), data])
    for at in range(0, len(data), _CHUNK):
        hashes = _rolling(padded[at:at + _CHUNK + WINDOW - 1])
        running = np.cumsum(hashes, dtype=np.uint64) + np.uint64(total)
        here = np.flatnonzero((hashes & np.uint32((1 << floor) - 1)) == 0)
        found = hashes[here].astype(np.int64) | (1 << 32)
        levels.append(np.log2(found & -found).astype(np.int64))
        sums.append(running[here])
        total = int(running[-1])
    if not levels:
        return np.empty(0, np.int64), np.empty(0, np.uint64), 0
    return np.concatenate(levels), np.concatenate(sums), total


def _signature(levels: np.ndarray, sums: np.ndarray, total: int, level: int) -> str:
    ends = np.append(sums[levels >= level], np.uint64(total))
    starts = np.concatenate([np.zeros(1, np.uint64), ends[:-1]])
    pieces = (ends - starts)[ends != starts]
    return _SYMBOLS[mix(pieces) >> np.uint64(58)].tobytes().decode()


def fingerprint(text: str | None) -> str:
    """`block size:signature:signature at twice the block size` of a whole text; null counts as empty.

    The block size is the least power of two, 4 or more, with at most 63 boundaries, so that a
    signature has at most 64 pieces of six bits, the last up to the end of the text.
    """
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    likely = max(LEAST, (len(data) // PIECES).bit_length() - 4)
    for floor in dict.fromkeys((likely, LEAST)):
        levels, sums, total = _triggers(data, floor)
        if len(levels) >= PIECES:
            break
    counts = len(levels) - np.cumsum(np.bincount(levels, minlength=34))
    level = floor if len(levels) < PIECES else int(np.argmax(counts < PIECES)) + 1
    return f"{1 << level}:{_signature(levels, sums, total, level)}:{_signature(levels, sums, total, level + 1)}"


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(t) for t in texts], np.int64)
    padded = b"".join([t.encode().ljust(PIECES) for t in texts])
    return _CODES[np.frombuffer(padded, np.uint8).reshape(len(texts), PIECES)], lengths


def signature_likeness(left: list[str], right: list[str]) -> np.ndarray:
    """1 less the edit distance (insertions and deletions) over both lengths; 0 without a common run.

    All pairs go through the recurrence at once, one bit of a word for a piece of the left signature.
    """
    (a, m), (b, n) = _codes(left), _codes(right)
    rows, one = np.arange(len(a)), np.uint64(1)
    places = np.zeros((len(a), PIECES + 1), np.uint64)
    for j in range(PIECES):
        places[rows, a[:, j]] |= one << np.uint64(j)
    places[:, PIECES] = 0
    state = np.full(len(a), 0xFFFFFFFFFFFFFFFF, np.uint64)
    runs, longest = np.zeros((_RUN, len(a)), np.uint64), np.zeros(len(a), np.int64)
    for j in range(PIECES):
        same = places[rows, b[:, j]]
        state = (state + (state & same)) | (state & ~same)
        runs[1:] = (runs[:-1] << one) & same
        runs[0] = same
        longest = np.maximum(longest, np.count_nonzero(runs, axis=0))
    common = np.bitwise_count(~state).astype(np.int64)
    shorter = np.minimum(m, n)
    alike = (shorter > 0) & (longest >= np.clip((shorter + 2) // 3, 1, _RUN))
    return np.where(alike, 2.0 * common / np.maximum(m + n, 1), 0.0)


def likeness(left: list[str], right: list[str]) -> np.ndarray:
    """Likeness of fingerprints, pair by pair: 1 for equal ones, else that of the signatures of one block size.

    Fingerprints whose block sizes are further apart than a factor of two are not alike.
    """
    result, pairs = np.zeros(len(left)), []
    for i, (x, y) in enumerate(zip(left, right)):
        if x == y:
            result[i] = 1.0
            continue
        (size, *own), (other, *others) = x.split(":"), y.split(":")
        size, other = int(size), int(other)
        for step, (mine, yours) in enumerate(((size, other), (2 * size, other), (size, 2 * other), (2 * size, 2 * other))):
            if mine == yours:
                pairs.append((i, own[step % 2], others[step // 2]))
    if pairs:
        at, a, b = zip(*pairs)
        np.maximum.at(result, list(at), signature_likeness(list(a), list(b)))
    return result


def edited(text: str, following: str) -> str:
    """The last quarter of a text replaced by as much of the beginning of the next one."""
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def _compared(ids: list, texts: list[str], prints: list[str]) -> dict[str, list]:
    """The result's columns of all texts but the last, each with the next as its follower."""
    changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
    again = [mark if len(text) < 4 else fingerprint(new) for text, mark, new in zip(texts, prints, changed)]
    return {"doc_id": ids[:-1], "n_chars": [len(t) for t in texts[:-1]], "edited_sha256": [_sha256(t) for t in changed],
            "fingerprint": prints[:-1], "edited_fingerprint": again,
            "near_edited": likeness(prints[:-1], again).tolist(), "near_next": likeness(prints[:-1], prints[1:]).tolist()}


_RESULT = (("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
           ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()))
_RESULT_SQL = """n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,
near_edited double, near_next double"""


def _schema(ids: pa.DataType, ends: bool) -> pa.Schema:
    extra = (("part", pa.int64()), ("head", pa.string()), ("tail", pa.string())) if ends else ()
    return pa.schema([("doc_id", ids), *_RESULT, *extra])


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, each compared with the next.

    What only neighbouring partitions can tell stays open: a row with the first text (head), and one with
    the last text (tail), which has no follower here.
    """
    part, ids, texts, prints, held, schema, first = TaskContext.get().partitionId(), [], [], [], 0, None, True

    def flush(last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal ids, texts, prints, held, first
        rows = _compared(ids, texts, prints)
        n = len(rows["doc_id"])
        rows |= {"part": [part] * n, "head": [None] * n, "tail": [None] * n}
        ends = ([(texts[0], None)] if first else []) + ([(None, texts[-1])] if last else [])
        for head, tail in ends:
            for name, _ in _RESULT:
                rows[name].append(None)
            rows["doc_id"].append(None if tail is None else ids[-1])
            for name, value in (("part", part), ("head", head), ("tail", tail)):
                rows[name].append(value)
        ids, texts, prints, first = ids[-1:], texts[-1:], prints[-1:], False
        held = 0
        yield pa.RecordBatch.from_pydict(rows, schema=schema)

    for batch in batches:
        schema = schema or _schema(batch.schema.field("doc_id").type, True)
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
            ids.append(doc_id.as_py())
            texts.append(text.as_py())
            prints.append(fingerprint(texts[-1]))
            held += len(texts[-1])
            if len(ids) > _ROWS or held > _CHARS:
                yield from flush(False)
    if ids:
        yield from flush(True)


def _at_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Last rows of partitions, each with the first text of the next."""
    for batch in batches:
        for row in range(batch.num_rows):
            doc_id, *texts = (batch.column(name)[row].as_py() for name in ("doc_id", "tail", "head"))
            rows = _compared([doc_id, None], texts, [fingerprint(t) for t in texts])
            yield pa.RecordBatch.from_pydict(rows, schema=_schema(batch.schema.field("doc_id").type, False))


def neighbour_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, compared with each other and with the next document's.

    The next document is the one that follows by doc_id, and the first after the last; nulls come first, and rows of
    one id go by a hash of their text, repeated rows after one another. The edited text has its last
    floor(n_chars / 4) code points replaced by as many of the next one's first, or all it has.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. A null text
    is empty; an empty one has no pieces and is like another empty one only. A text of under four characters is
    its own edited text; a single document is its own next. Other columns are ignored; no rows give no rows.

    The texts are shuffled once, into ranges of the order, and a task holds 4 million characters or one text at a
    time. Only the first and the last text of a partition are written, to be compared across partitions.
    """
    spark = docs.sparkSession
    ship_library(spark)
    work = Workspace(spark)
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    keyed = texts.select("*", F.xxhash64("text").alias("_hash"), F.monotonically_increasing_id().alias("_row"))
    ids = docs.schema["doc_id"].dataType.simpleString()
    columns = f"doc_id {ids}, {_RESULT_SQL}"
    written = work.save(in_order(keyed, "doc_id", "_hash", "_row").select("doc_id", "text")
                        .mapInArrow(_along, f"{columns}, part long, head string, tail string"))

    heads = written.filter("head IS NOT NULL").select("part", "head")
    order = Window.orderBy("part")  # a row for each partition that has rows, without its text
    parts = heads.select("part").select("part", F.coalesce(F.lead("part").over(order), F.first("part").over(order)).alias("next"))
    ends = (written.filter("tail IS NOT NULL").select("doc_id", "part", "tail").join(parts, "part")
            .join(heads.select(F.col("part").alias("next"), "head"), "next").select("doc_id", "tail", "head"))
    whole = written.filter("head IS NULL AND tail IS NULL").drop("part", "head", "tail")
    return whole.unionByName(ends.mapInArrow(_at_ends, columns))
