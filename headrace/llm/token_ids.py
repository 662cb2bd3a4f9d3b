"""Token ids as one concatenated array per block, with Elias-Fano coded document boundaries."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headrace.llm.tables import ship_library

END_ID = 2
# A block is closed once it holds this many ids; a longer document has a block of its own.
BLOCK_IDS = 1 << 22
# Words whose ids a worker keeps between tasks; the cache is emptied when it is full.
CACHE_WORDS = 1_500_000
SELECT_STEP = 64

BLOCK_SCHEMA = ("part int, block int, n_docs long, n_ids long, doc_ids binary, ids binary, low_bits int, "
                "low binary, high binary, samples binary")


# --- Elias-Fano -------------------------------------------------------------------------------

def ef_encode(values: np.ndarray) -> tuple[int, bytes, bytes, bytes]:
    """Code non-decreasing numbers >= 0: low-bit width, low bits, high bits in unary, select samples.

    Each number keeps its lowest bits as they are; the rest is written as a one at position
    (high part + index). Samples hold the position of every SELECT_STEP-th one.
    """
    values = np.asarray(values, np.uint64)
    n, last = len(values), int(values[-1]) if len(values) else 0
    width = max(0, (max(1, last // max(1, n))).bit_length() - 1)
    shifts = np.arange(width, dtype=np.uint64)
    low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
    ones = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
    bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
    bits[ones] = 1
    return (width, low.tobytes(), np.packbits(bits, bitorder="little").tobytes(),
            ones[::SELECT_STEP].astype("<u4").tobytes())


def ef_select(index: int, width: int, low: bytes, high: bytes, samples: bytes) -> int:
    """The number at `index`, from a sampled position and a scan of at most SELECT_STEP ones."""
    at = int(np.frombuffer(samples, "<u4", 1, 4 * (index // SELECT_STEP))[0])
    left, byte = index % SELECT_STEP, at >> 3
    here = high[byte] >> (at & 7) << (at & 7)
    while (ones := here.bit_count()) <= left:
        left -= ones
        byte += 1
        here = high[byte]
    for _ in range(left):
        here &= here - 1
    position = 8 * byte + (here & -here).bit_length() - 1
    first = index * width
    chunk = int.from_bytes(low[first >> 3:(first + width + 7) >> 3], "little")
    return (position - index) << width | chunk >> (first & 7) & ((1 << width) - 1)


def ef_decode(n: int, width: int, low: bytes, high: bytes) -> np.ndarray:
    """All n numbers."""
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(high, np.uint8), bitorder="little"))[:n]
    bits = np.unpackbits(np.frombuffer(low, np.uint8), count=n * width, bitorder="little").reshape(n, width)
    lows = (bits.astype(np.int64) << np.arange(width)).sum(axis=1) if width else 0
    return (ones - np.arange(n) << width) + lows


# --- ids ----------------------------------------------------------------------------------------

@lru_cache(1)
def _tokenizer(path: str):
    """The tokenizer, which of its ids end a word, and the words encoded so far."""
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    ends = np.zeros(tokenizer.get_vocab_size() + 1, bool)
    for token, number in tokenizer.get_vocab().items():
        ends[number] = token.endswith("</w>")
    return tokenizer, ends, {}


def _ids(tokenizer, text: str) -> np.ndarray:
    return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")


def _learn(tokenizer, ends: np.ndarray, cache: dict[bytes, bytes], words: set[bytes]) -> None:
    """Encode words not met before.

    Words of letters only are one piece each for the tokenizer's splitter: thousands are encoded
    at once and cut after the ids that end a word. Stops after a letter or digit are a piece of
    their own. All other words are encoded alone.
    """
    stems = {w: w.rstrip(b".,!?;:") for w in words}
    tailed = {w: s for w, s in stems.items() if s != w and s[-1:].isalnum()}
    missing = (words - tailed.keys()) | set(tailed.values()) | {w[len(s):] for w, s in tailed.items()}
    missing = [w for w in missing if w not in cache]
    plain = [w for w in missing if w.decode().isalpha()]
    for at in range(0, len(plain), 2000):
        some = plain[at:at + 2000]
        ids = _ids(tokenizer, " ".join(w.decode() for w in some))
        cuts = np.flatnonzero(ends[ids]) + 1
        if len(cuts) == len(some):
            data = ids.tobytes()
            cache.update({w: data[4 * a:4 * b] for w, a, b in zip(some, [0, *cuts[:-1].tolist()], cuts.tolist())})
    cache.update({w: _ids(tokenizer, w.decode()).tobytes() for w in missing if w not in cache})
    cache.update({w: cache[s] + cache[w[len(s):]] for w, s in tailed.items()})


def encode_texts(texts: list[str | None], tokenizer_path: str) -> list[bytes]:
    """Little-endian 32-bit ids of each text, as the tokenizer gives them for the whole text.

    The tokenizer must split at spaces and line ends and keep runs of letters apart from other
    characters, as its file says of its normalizer and splitter; then a text's ids are those of
    its words in turn, and each word is encoded once, as it stands, and looked up afterwards.
    """
    tokenizer, ends, cache = _tokenizer(tokenizer_path)
    split = [(t or "").encode().replace(b"\n", b" ").split(b" ") for t in texts]
    found = [list(map(cache.get, words)) for words in split]
    new = {w for words, got in zip(split, found) if None in got for w, g in zip(words, got) if g is None}
    if new:
        if len(cache) + len(new) > CACHE_WORDS:
            cache.clear()
            new = set().union(*split)
        _learn(tokenizer, ends, cache, new)
        found = [list(map(cache.get, words)) if None in got else got for words, got in zip(split, found)]
    return [b"".join(got) for got in found]


def _blocks(tokenizer_path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, block, size, doc_ids, coded = TaskContext.get().partitionId(), 0, 0, [], []
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                for doc, ids in zip(some.column(0).to_pylist(),
                                    encode_texts(some.column(1).to_pylist(), tokenizer_path)):
                    if coded and size + len(ids) // 4 >= BLOCK_IDS:
                        yield _block(part, block, doc_ids, coded)
                        block, size, doc_ids, coded = block + 1, 0, [], []
                    doc_ids.append(doc)
                    coded.append(ids + end)
                    size += len(ids) // 4 + 1
        if coded:
            yield _block(part, block, doc_ids, coded)
    return run


def _block(part: int, block: int, doc_ids: list[int | None], coded: list[bytes]) -> pa.RecordBatch:
    """One block: 16-bit ids while they fit, boundaries coded, document ids as 64-bit numbers."""
    starts = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded])])
    width, low, high, samples = ef_encode(starts)
    ids = np.frombuffer(b"".join(coded), "<u4")
    if ids.max() < 1 << 16:
        ids = ids.astype("<u2")
    row = [part, block, len(coded), int(starts[-1]), np.array(doc_ids, "<i8").tobytes(), ids.tobytes(),
           width, low, high, samples]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 2, pa.int32(), *[pa.binary()] * 3]
    names = [f.split()[0] for f in BLOCK_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, id_column: str = "doc_id",
              text_column: str = "text") -> None:
    """Encode every text, append the end id, and write blocks in ascending id order to a folder.

    The folder is a Parquet table of blocks (part, block): the concatenated ids of consecutive
    documents, and their boundaries Elias-Fano coded with select samples, in about
    2 + log2(mean length) bits a document. Documents are dealt by ranges of their id, so blocks in
    (part, block) order hold them in ascending order; documents of one id follow each other in the
    order of their texts. A null text counts as empty (only its end id); rows with a null id are
    an error; other columns are ignored; an empty table gives a folder without blocks.
    """
    spark = docs.sparkSession
    ship_library(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    checked = F.coalesce(F.col(id_column), F.raise_error(F.lit("a document has no id")).cast("long")).cast("long")
    rows = docs.select(checked.alias("doc"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange(parts, "doc").sortWithinPartitions("doc", "text")
    ordered.mapInArrow(_blocks(tokenizer_path, end_id), BLOCK_SCHEMA).write.parquet(path)


def open_ids(spark: SparkSession, path: str) -> DataFrame:
    """The blocks of a folder with first_id, the number of ids in all blocks before.

    One row per block is sorted for the sums, without the blocks' contents.
    """
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    before = Window.orderBy("part", "block").rowsBetween(Window.unboundedPreceding, -1)
    sums = blocks.select("part", "block", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first_id"))
    return blocks.join(sums, ["part", "block"])


def read_documents(blocks: DataFrame) -> DataFrame:
    """One row per document out of the blocks: doc_id, start, n_tokens, ids (little-endian 32 bit)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ends = ef_decode(row["n_docs"] + 1, row["low_bits"], row["low"], row["high"])
                ids = np.frombuffer(row["ids"], "<u2" if len(row["ids"]) == 2 * row["n_ids"] else "<u4").astype("<u4")
                docs = np.frombuffer(row["doc_ids"], "<i8")
                for at in range(0, len(docs), 1000):
                    cut = ends[at:at + 1001]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(docs[at:at + 1000]), pa.array(row["first_id"] + cut[:-1]), pa.array(np.diff(cut)),
                         pa.array([ids[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"])
    ship_library(blocks.sparkSession)
    return blocks.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def document_ids(block: dict, index: int) -> np.ndarray:
    """The ids of one document of a block, found by two selects."""
    code = (block["low_bits"], block["low"], block["high"], block["samples"])
    start, end = ef_select(index, *code), ef_select(index + 1, *code)
    size = len(block["ids"]) // block["n_ids"]
    return np.frombuffer(block["ids"], f"<u{size}", end - start, size * start).astype(np.uint32)
