import random
from datetime import date

import xxhash
from pyspark.sql import functions as F

from ledgerloom.functions import KeyScheme, date_key, hash_key, nullable_hash_key
from ledgerloom.operators import audit


def test_murmur_keys_have_their_published_values(spark):
    keys = spark.sql("SELECT id FROM VALUES (0L), (1L) AS t(id)").select(
        hash_key(F.col("id"), KeyScheme.MURMUR32).alias("key")
    )
    assert [r.key for r in keys.collect()] == [1670924195, 1712319331]
    assert keys.dtypes == [("key", "bigint")]


M32, M64 = (1 << 32) - 1, (1 << 64) - 1


def plain_murmur(data: bytes) -> int:
    """Murmur3 over words of four bytes, then over each byte left as a signed number; absolute."""

    def turned(x, by):
        return ((x << by) | (x >> (32 - by))) & M32

    whole = len(data) // 4 * 4
    words = [int.from_bytes(data[i : i + 4], "little") for i in range(0, whole, 4)]
    words += [b - 256 if b > 127 else b for b in data[whole:]]
    h = 42
    for word in words:
        h ^= turned(word * 0xCC9E2D51 & M32, 15) * 0x1B873593 & M32
        h = (turned(h, 13) * 5 + 0xE6546B64) & M32
    h ^= len(data)
    h = (h ^ (h >> 16)) * 0x85EBCA6B & M32
    h = (h ^ (h >> 13)) * 0xC2B2AE35 & M32
    h ^= h >> 16
    return abs(h - (1 << 32) if h >> 31 else h)


def texts():
    shuffled = random.Random(6)
    signs = "abcXYZ0189_- é߀語🙂"
    return ["", "S10_1678", "1", *("".join(shuffled.choices(signs, k=n)) for n in range(90) for _ in range(2))]


def test_text_keys_equal_independent_hashes(spark):
    """Keys of UTF-8 texts of any length, and of 32-bit numbers, as the sources have them."""
    rows = spark.createDataFrame([(t,) for t in texts()], "t string").select(
        "t", *(hash_key(F.col("t"), s).alias(s.value) for s in KeyScheme)
    )
    for row in rows.collect():
        data = row.t.encode()
        assert row.murmur32 == plain_murmur(data), row.t
        wide = xxhash.xxh64_intdigest(data, 42)
        assert row.xxhash64 == (wide - (1 << 64) if wide >> 63 else wide), row.t
    numbers = [0, 1, 103, -1, 2**31 - 1, -(2**31)]
    rows = spark.createDataFrame([(n,) for n in numbers], "n int").select(
        "n", *(hash_key(F.col("n"), s).alias(s.value) for s in KeyScheme)
    )
    for row in rows.collect():
        data = row.n.to_bytes(4, "little", signed=True)
        assert row.murmur32 == plain_murmur(data)
        wide = xxhash.xxh64_intdigest(data, 42)
        assert row.xxhash64 == (wide - (1 << 64) if wide >> 63 else wide)


def test_murmur_key_of_the_smallest_hash(spark):
    """The absolute value of the smallest 32-bit number needs 64 bits."""
    row = spark.range(1957873941, 1957873942).select(
        F.hash("id").alias("hashed"), hash_key(F.col("id"), KeyScheme.MURMUR32).alias("key")
    ).first()
    assert (row.hashed, row.key) == (-(2**31), 2**31)


def test_key_depends_on_type(spark):
    row = spark.range(1).select(
        hash_key(F.lit(103).cast("int"), KeyScheme.MURMUR32).alias("as_int"),
        hash_key(F.lit(103).cast("smallint"), KeyScheme.MURMUR32).alias("as_smallint"),
        hash_key(F.lit(103).cast("bigint"), KeyScheme.MURMUR32).alias("as_bigint"),
        hash_key(F.lit("103"), KeyScheme.MURMUR32).alias("as_text"),
    ).first()
    assert row.as_int == row.as_smallint
    assert len({row.as_int, row.as_bigint, row.as_text}) == 3


def test_nullable_key_keeps_null(spark):
    for scheme in KeyScheme:
        row = spark.sql("SELECT CAST(NULL AS INT) AS id").select(
            nullable_hash_key(F.col("id"), scheme).alias("kept"),
            hash_key(F.col("id"), scheme).alias("hashed"),
        ).first()
        assert row.kept is None
        assert row.hashed == 42


def test_wide_keys_do_not_collide_where_narrow_ones_do(spark):
    ids = spark.range(400_000).select(F.col("id").alias("natural"))
    counts = {}
    for scheme in KeyScheme:
        keyed = ids.withColumn("key", hash_key(F.col("natural"), scheme))
        counts[scheme] = audit.key_collisions({"t": (keyed, "natural", "key")}).first()
    narrow, wide = counts[KeyScheme.MURMUR32], counts[KeyScheme.XXHASH64]
    assert narrow.row_count == wide.row_count == wide.distinct_keys == 400_000
    assert narrow.colliding_keys > 0 and wide.colliding_keys == 0


def test_date_key(spark):
    days = spark.createDataFrame([(date(2020, 2, 29),), (date(2024, 1, 5),), (None,)], "d date")
    result = days.select(
        date_key(F.col("d")).alias("key"),
        F.date_format("d", "yyyyMMdd").cast("int").alias("formatted"),
    )
    assert result.dtypes[0] == ("key", "int")
    assert [(r.key, r.formatted) for r in result.collect()] == [
        (20200229, 20200229),
        (20240105, 20240105),
        (None, None),
    ]
