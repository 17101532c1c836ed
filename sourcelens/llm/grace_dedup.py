"""Exact deduplication by Grace hashing: partition until a bucket fits a table in memory, then compare whole contents there.

1. A scan takes hash and size of every text.  Buckets are the leading bits of the hash; a bucket whose distinct contents exceed the size of a table is
   partitioned again by more bits, level by level, until every bucket fits or holds a single content.  Only hashes and sizes move so far.
2. Each task puts its texts into a small open-addressing table.  Of equal texts within a table only the row of the largest id carries the content, compressed; so
   a hot text leaves a task once, however many rows have it.
3. One exchange deals the contents out: its files are the buckets' spill files, and each content is written and moved once.  A task streams its buckets,
   sorted one after the other, through an open-addressing table with linear probing.  Equal hashes decide nothing: a row joins an entry only if
   the complete contents are equal.
4. The other rows, repeats within a first table, take their group by that table's number of the content.

Nothing of a group is ever gathered but one content for each first table.

Defined cases: null counts as empty, and empty texts are equal; only A-Z is lower-cased; of equal texts the row of the largest id stays, of several such rows
exactly one; a null id is smaller than any other, so ``keep_id`` is null only if all ids of a group are; an empty table gives an empty
result; texts of any length are compared whole; only id and text are read, so further columns can't clash.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sourcelens.llm.common import arrow_schema, map_arrow, shared_folder

#: Bytes of distinct contents that a bucket's table may hold, and those of a task's first table.
TABLE_BYTES = 32 << 20
FIRST_TABLE_BYTES = 8 << 20
FIRST_TABLE_ROWS = 50_000
#: Bits of the hash that each level adds to the first one's.
LEVEL_BITS = 4

ROWS = "bucket string, id bigint, place bigint, top boolean, n bigint, hash bigint, content binary, sha256 binary"
GROUPS = "id bigint, place bigint, top boolean, keep_id bigint, group_size bigint, kept boolean, sha256 binary"


def normalised(text: str | None) -> bytes:
    """UTF-8 with A-Z lower-cased."""
    return (text or "").encode().lower()


class Table:
    """Open addressing with linear probing: hash and content to a number, in order of arrival.  ``same(i, content)`` compares an entry's
    complete content; at most half of the slots are used."""

    def __init__(self, same: Callable[[int, bytes], bool], slots: int = 64):
        self.same, self.hashes, self.slots = same, array("q"), array("q", [-1]) * slots

    def _grow(self) -> None:
        mask = 2 * len(self.slots) - 1
        self.slots = array("q", [-1]) * (mask + 1)
        for number, h in enumerate(self.hashes):
            at = h & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = number

    def find_or_add(self, h: int, content: bytes) -> tuple[int, bool]:
        """The content's number, and whether it is new."""
        slots, mask = self.slots, len(self.slots) - 1
        at = h & mask
        while (number := slots[at]) >= 0:
            if self.hashes[number] == h and self.same(number, content):
                return number, False
            at = (at + 1) & mask
        number = slots[at] = len(self.hashes)
        self.hashes.append(h)
        if 2 * len(self.hashes) > len(slots):
            self._grow()
        return number, True


def _less(a: int | None, b: int | None) -> bool:
    return b is not None and (a is None or a < b)


def _first_tables(rows: DataFrame, table_bytes: int, table_rows: int) -> DataFrame:
    """(id, text, hash, bucket) to rows of the exchange.  ``place`` numbers the contents of all first tables; the row with ``top`` carries a place's
    content, the others go where their place sends them."""
    schema = arrow_schema(rows.sparkSession, ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 40
        contents: list[bytes] = []
        ids: list[list] = []
        tops: list[int] = []
        buckets: list[str] = []

        def flush():
            cols = [[] for _ in schema]
            for number, content in enumerate(contents):
                for row, id_ in enumerate(ids[number]):
                    if row == tops[number]:
                        own = (buckets[number], id_, place + number, True, len(ids[number]), table.hashes[number], zlib.compress(content, 1), hashlib.sha256(content).digest())
                    else:
                        own = (f"-{place + number}", id_, place + number, False, None, None, None, None)
                    for col, x in zip(cols, own, strict=True):
                        col.append(x)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

        table, held, count = Table(lambda i, x: contents[i] == x), 0, 0
        for batch in batches:
            for id_, value, h, bucket in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                content = normalised(value.as_py())
                number, new = table.find_or_add(h, content)
                if new:
                    contents.append(content)
                    ids.append([])
                    tops.append(0)
                    buckets.append(bucket)
                    held += len(content)
                elif _less(ids[number][tops[number]], id_):
                    tops[number] = len(ids[number])
                ids[number].append(id_)
                count += 1
                if held >= table_bytes or count >= table_rows:
                    yield flush()
                    place += len(contents)
                    contents, ids, tops, buckets, held, count = [], [], [], [], 0, 0
                    table = Table(lambda i, x: contents[i] == x)
        if count:
            yield flush()

    return map_arrow(rows.select("id", "text", "hash", "bucket"), run, ROWS)


def _last_tables(rows: DataFrame) -> DataFrame:
    """A row for each row, those with contents sorted by bucket: its group, or only its place.  Each bucket has a table of its own."""
    schema = arrow_schema(rows.sparkSession, GROUPS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, members, contents = None, [], []

        def same(i: int, packed: bytes) -> bool:
            return contents[i] == packed or zlib.decompress(contents[i]) == zlib.decompress(packed)

        def groups() -> list[tuple]:
            out = []
            for own in members:  # (id, place, n, sha256) of one content
                top = own[0]
                for m in own:
                    top = m if _less(top[0], m[0]) or top[0] == m[0] and m[1] < top[1] else top
                size = sum(m[2] for m in own)
                out += [(m[0], m[1], True, top[0], size, m is top, m[3]) for m in own]
            return out

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

        for batch in batches:
            out = []
            for r in zip(*(batch.column(k).to_pylist() for k in ("bucket", "id", "place", "top", "n", "hash", "sha256", "content")), strict=True):
                if not r[3]:
                    out.append((r[1], r[2], False, None, None, False, None))
                    continue
                if r[0] != bucket:
                    out += groups()
                    bucket, members, contents = r[0], [], []
                    table = Table(same)
                number, new = table.find_or_add(r[5], r[7])
                if new:
                    members.append([])
                    contents.append(r[7])
                members[number].append((r[1], r[2], r[4], r[6]))
            if out:
                yield batch_of(out)
        if members:
            yield batch_of(groups())

    return map_arrow(rows.select("bucket", "id", "place", "top", "n", "hash", "sha256", "content"), run, GROUPS)


def _written(df: DataFrame, folder: str) -> DataFrame:
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def _leading(bits: int) -> Column:
    return F.shiftrightunsigned("hash", 64 - bits)


def overfull(sizes: DataFrame, folder: str, table_bytes: int, first_bits: int) -> list[tuple[int, DataFrame | None]]:
    """For each level its bits and the table (bucket) of those of its buckets that must be partitioned again; the last level has none.  ``sizes``: (hash, size) of
    distinct contents."""
    levels, bits, rows = [], first_bits, sizes
    while True:
        full = (rows.groupBy(_leading(bits).alias("bucket")).agg(F.sum("size").alias("bytes"), F.count("*").alias("contents"))
                .where((F.col("bytes") > table_bytes) & (F.col("contents") > 1)).select("bucket"))
        if bits >= 60 or full.isEmpty():
            return [*levels, (bits, None)]
        full = _written(full, f"{folder}/overfull-{len(levels)}")
        levels.append((bits, full))
        rows = rows.withColumn("bucket", _leading(bits)).join(full, "bucket", "left_semi").drop("bucket")
        bits = min(60, bits + LEVEL_BITS)


def with_bucket(rows: DataFrame, levels: list[tuple[int, DataFrame | None]]) -> DataFrame:
    """``rows`` plus the name of the bucket that fits.  Each overfull bucket holds more than a table's bytes, so their number is bounded by the input's size over
    that of a table; Spark broadcasts them while they are small."""
    name = None
    for level, (bits, full) in enumerate(levels):
        here = F.concat(F.lit(f"{level}."), _leading(bits).cast("string"))
        if full is None:
            last = here
        else:
            rows = rows.join(full.select(F.col("bucket").alias(f"_full{level}")), _leading(bits) == F.col(f"_full{level}"), "left")
            done = F.col(f"_full{level}").isNull()
            name = F.when(done, here) if name is None else name.when(done, here)
    return rows.withColumn("bucket", last if name is None else name.otherwise(last)).drop(*[f"_full{i}" for i in range(len(levels))])


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", table_bytes: int = TABLE_BYTES, first_table_bytes: int = FIRST_TABLE_BYTES,
                     first_table_rows: int = FIRST_TABLE_ROWS, hash_of: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256), a row for every row of ``docs``."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/grace-{uuid.uuid4().hex}"
    lower = F.lower(F.coalesce(F.col(text), F.lit("")))  # joins more texts than A-Z does, which the comparison sets apart
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text).alias("text"), hash_of(lower).alias("hash"))
    sizes = _written(rows.groupBy("hash").agg(F.max(F.coalesce(F.octet_length("text"), F.lit(0))).alias("size")), f"{folder}/sizes")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    levels = overfull(sizes, folder, table_bytes, max(1, max(2 * total // table_bytes, 8 * parts).bit_length()))  # half full on average
    dealt = _first_tables(with_bucket(rows, levels), first_table_bytes, first_table_rows).repartition("bucket")
    groups = _written(_last_tables(dealt.sortWithinPartitions("bucket")), f"{folder}/groups")
    found = groups.where("top")
    repeats = (groups.where("not top").select("id", "place").join(found.select("place", "keep_id", "group_size", "sha256"), "place")
               .select("id", "keep_id", "group_size", F.lit(False).alias("kept"), "sha256"))
    return found.select("id", "keep_id", "group_size", "kept", "sha256").unionByName(repeats).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.lower(F.hex("sha256")).alias("text_sha256"))
