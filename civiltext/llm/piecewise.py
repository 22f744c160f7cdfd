"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over the last ``WINDOW`` bytes ends a chunk wherever it is a multiple of the
block size; every chunk gives one character of the signature. An edit changes the characters of
the chunks it touches and no others. A fingerprint is ``block:signature:signature`` with the
signatures at the block size and at twice that, so that texts of similar length are comparable.

The likeness of two fingerprints is taken at a block size both have: one minus their edit
distance (insertions and deletions) over their total length, or 0 if they have no common run
of ``COMMON`` characters (half the shorter signature if that is less). Equal
fingerprints have likeness 1; fingerprints without a common block size 0.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from civiltext.llm.words import INVERSE, mix, powers

WINDOW = 7
SMALLEST = 3
CHUNKS = 64
COMMON = 7
ALPHABET = np.frombuffer(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)


def _signature(data: np.ndarray, sums: np.ndarray, ends: np.ndarray) -> str:
    """One character per chunk; the rest after the last end is a chunk as well."""
    edges = np.append(ends[ends < len(data)], len(data))
    begin = np.concatenate([[0], edges[:-1]])
    value = mix((sums[edges] - sums[begin]) * powers(len(data), INVERSE)[begin])
    return ALPHABET[(value & np.uint64(63)).astype(np.int64)].tobytes().decode()


def fingerprint(text: str) -> str:
    """The fingerprint of the UTF-8 bytes of ``text``."""
    data = np.frombuffer(text.encode(), np.uint8)
    if not len(data):
        return f"{SMALLEST}::"
    values = data.astype(np.uint64) + np.uint64(1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values * powers(len(data))[:len(data)], out=sums[1:])
    begin = np.maximum(np.arange(1, len(data) + 1) - WINDOW, 0)
    rolled = mix((sums[1:] - sums[begin]) * powers(len(data), INVERSE)[begin])
    # Compared by its upper half, so that a block and its double share chunk ends.
    rolled = (rolled >> np.uint64(32)).astype(np.int64)
    block = SMALLEST
    while block * CHUNKS < len(data):
        block *= 2
    third = np.flatnonzero(rolled % SMALLEST == 0)
    times = rolled[third] // SMALLEST

    def ends(size: int) -> np.ndarray:
        return third[times % (size // SMALLEST) == 0] + 1

    at = ends(block)
    while block > SMALLEST and len(at) < CHUNKS // 2:
        block //= 2
        at = ends(block)
    return f"{block}:{_signature(data, sums, at)}:{_signature(data, sums, ends(2 * block))}"


def edit_likeness(a: str, b: str) -> float:
    """One minus the edit distance over the total length, from the longest common subsequence."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    if len(b) < len(a):
        a, b = b, a
    run = min(COMMON, (len(a) + 1) // 2)
    if not any(a[i:i + run] in b for i in range(len(a) - run + 1)):
        return 0.0
    # Bit-parallel longest common subsequence over the bits of one integer.
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    rows = full
    for c in b:
        hit = rows & where.get(c, 0)
        rows = ((rows + hit) | (rows - hit)) & full
    common = len(a) - rows.bit_count()
    return 2 * common / (len(a) + len(b))


def likeness(a: str, b: str) -> float:
    """Likeness of two fingerprints, 0 to 1."""
    if a == b:
        return 1.0
    size_a, one_a, two_a = a.split(":")
    size_b, one_b, two_b = b.split(":")
    size_a, size_b = int(size_a), int(size_b)
    if size_a == size_b:
        return max(edit_likeness(one_a, one_b), edit_likeness(two_a, two_b))
    if size_a == 2 * size_b:
        return edit_likeness(one_a, two_b)
    if size_b == 2 * size_a:
        return edit_likeness(two_a, one_b)
    return 0.0


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by the start of ``following``."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, fingerprint``, one row per row of ``docs``; a missing text is empty."""
    @F.arrow_udf("string")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t) for t in texts.to_pylist()], pa.string())

    return docs.select(F.col(id_col).alias("id"),
                       of(F.coalesce(text_col, F.lit(""))).alias("fingerprint"))


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document against the row after it; the last row of a bucket only ends it."""
    before = None
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("bucket", "id", "text", "closes")))
        out = []
        for bucket, id_, text, closes in rows:
            here = (bucket, closes, id_, text, fingerprint(text))
            if before is not None and before[0] == bucket and not before[1]:
                out.append(_against(*before[2:], *here[3:]))
            before = here
        types = [batch.schema.field("id").type, pa.int64(), pa.string(), pa.string(),
                 pa.string(), pa.float64(), pa.float64()]
        columns = zip(*out) if out else [()] * len(types)
        yield pa.RecordBatch.from_arrays(
            [pa.array(values, kind) for values, kind in zip(columns, types)], names=NAMES)


NAMES = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
         "near_next"]


def _against(id_, text: str, mark: str, following: str, next_mark: str) -> tuple:
    changed = edited(text, following)
    changed_mark = fingerprint(changed) if changed != text else mark
    return (id_, len(text), hashlib.sha256(changed.encode()).hexdigest(), mark, changed_mark,
            likeness(mark, changed_mark), likeness(mark, next_mark))


def neighbour_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       buckets: int | None = None) -> DataFrame:
    """Each text's fingerprint against that of its edited text and of the next document.

    Documents are taken by id (a number; missing ids first, equal ones by text), the first
    follows the last. The edited text has its last quarter of code points replaced by the
    first as many of the next document. A missing text is empty; other columns are not read.

    Texts are shuffled once, by ranges of ids. What has to be known across a range's end, the
    next range's first document, is added to it: one row per range.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = buckets or 8 * parts
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    bounds = np.unique(docs.approxQuantile(
        "id", [i / buckets for i in range(1, buckets)], 0.25 / buckets) or [0.0])

    @F.arrow_udf("int")
    def bucket(ids: pa.Array) -> pa.Array:
        values = ids.cast(pa.float64(), safe=False).fill_null(-np.inf)
        return pa.array(np.searchsorted(bounds, values.to_numpy(zero_copy_only=False))
                        .astype(np.int32))

    docs = docs.withColumn("bucket", bucket("id"))
    # At most ``buckets`` rows.
    heads = sorted(docs.groupBy("bucket").agg(F.min(F.struct("id")).alias("head")).collect())
    after = [(row.bucket, row.head.id, heads[i - 1].bucket) for i, row in enumerate(heads)]
    id_type = docs.schema["id"].dataType.simpleString()
    after = spark.createDataFrame(after, f"head_bucket int, head_id {id_type}, target int")
    closers = (docs.join(F.broadcast(after), (F.col("bucket") == F.col("head_bucket"))
                         & F.col("id").eqNullSafe(F.col("head_id")))
               .groupBy("target", "id").agg(F.min("text").alias("text"))
               .select(F.col("target").alias("bucket"), "id", "text", F.lit(True).alias("closes")))
    rows = docs.select("bucket", "id", "text", F.lit(False).alias("closes")).unionByName(closers)
    return (rows.repartition(parts, "bucket").sortWithinPartitions("bucket", "closes", "id", "text")
            .mapInArrow(_neighbours, f"id {id_type}, n_chars long, edited_sha256 string, "
                                     "fingerprint string, edited_fingerprint string, "
                                     "near_edited double, near_next double"))
