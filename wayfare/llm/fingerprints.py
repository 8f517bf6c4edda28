"""Document fingerprints: one-permutation MinHash in DataFrame functions.

Each word shingle is hashed once. The top bits of the hash choose a bin and a bin keeps
its smallest hash. An empty bin takes over the value of a filled one, found by a probe
sequence of its own that visits every bin (optimal densification: the choice depends on
the bin alone, so two documents that agree on the filled bins agree on the empty ones).
Of each bin the low bits are stored, one hexadecimal digit a bin.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, shielded, sqrt_blocks

#: Bins (a power of two) and the bits kept of each; 4 bits make one hexadecimal digit.
BINS = 256
BITS = 4
SHINGLE = 5
#: Probes unrolled before the exact search among all filled bins.
PROBES = 6
#: Quantiles of the keys, at most, between which rows are put in order.
MOST_BLOCKS = 20_000


def _probe_tables(bins: int) -> tuple[list[int], list[int], list[int]]:
    """For each empty bin i the sequence start + t * step (mod bins), t = 0, 1, ...; the
    step is odd, so that it visits all bins, and inverse undoes it."""
    random = np.random.default_rng(20240229)
    start = random.integers(0, bins, bins)
    step = random.integers(0, bins // 2, bins) * 2 + 1
    return start.tolist(), step.tolist(), [pow(int(s), -1, bins) for s in step]


def _ints(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")


def _kept(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with value as a column of its own that the optimizer will not copy into the
    expressions above, where a lambda would compute it again for each element."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def add_fingerprint(df: DataFrame, text: str, name: str, bins: int = BINS, shingle: int = SHINGLE) -> DataFrame:
    """df with a fingerprint column: bins hexadecimal digits, or '' for texts without
    words (null, empty or white space). Fewer words than a shingle count as one shingle. A
    column of that name is replaced; others come through whatever they are called."""
    return shielded(df, [text], lambda rows: _fingerprinted(rows, text, name, bins, shingle)).select(*[F.col(f"`{c}`") for c in df.columns if c != name], name)


def _fingerprinted(df: DataFrame, text: str, name: str, bins: int, shingle: int) -> DataFrame:
    shift = 63 - (bins.bit_length() - 1)
    start, step, inverse = map(_ints, _probe_tables(bins))
    words = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    df = _kept(df, "_words", words)
    n = F.size("_words")
    last = F.greatest(n - shingle, F.lit(0))
    # Missing words of a short text are null, which xxhash64 passes over.
    hashes = F.transform(F.sequence(F.lit(0), last), lambda i: F.shiftrightunsigned(F.xxhash64(*[F.get("_words", i + k) for k in range(shingle)]), 1))
    # One largest value for each bin closes it: after sorting, the first of each bin is its minimum or this.
    closing = F.array(*[F.lit(((j + 1) << shift) - 1) for j in range(bins)])
    df = _kept(df, "_sorted", F.when(n > 0, F.sort_array(F.concat(hashes, closing))))
    low = F.filter("_sorted", lambda h, i: (i == 0) | (F.shiftright(h, shift) != F.shiftright(F.get("_sorted", i - 1), shift)))
    df = _kept(df, "_bins", F.transform(low, lambda h: F.when(h.bitwiseAND((1 << shift) - 1) != (1 << shift) - 1, h)))
    filled = F.filter(F.sequence(F.lit(0), F.lit(bins - 1)), lambda j: F.get("_bins", j).isNotNull())
    df = _kept(df, "_filled", F.when(n > 0, filled))

    def value(h: Column, i: Column) -> Column:
        at, by = F.get(start, i), F.get(step, i)
        probes = [F.get("_bins", (at + t * by).bitwiseAND(bins - 1)) for t in range(PROBES)]
        nearest = F.array_min(F.transform("_filled", lambda j: ((j - at) * F.get(inverse, i)).bitwiseAND(bins - 1)))
        return F.coalesce(h, *probes, F.get("_bins", (at + nearest * by).bitwiseAND(bins - 1)))

    digits = F.transform(F.transform("_bins", value), lambda h: F.substring(F.lit("0123456789abcdef"), h.bitwiseAND(15).cast("int") + 1, F.lit(1)))
    packed = F.when(n > 0, F.array_join(digits, "")).otherwise("")
    return _kept(df, name, packed).drop("_words", "_sorted", "_bins", "_filled")


def likeness(a: Column, b: Column, bins: int = BINS, bits: int = BITS) -> Column:
    """Estimated Jaccard similarity of two fingerprints: the share of equal bins, less
    what bins of so few bits agree on by chance. Two empty ones are alike, an empty and
    another are not."""
    equal = F.size(F.filter(F.sequence(F.lit(1), F.lit(bins)), lambda i: F.substring(a, i, F.lit(1)) == F.substring(b, i, F.lit(1)))) / F.lit(float(bins))
    chance = 1.0 / (1 << bits)
    unbiased = F.least(F.greatest((equal - chance) / (1 - chance), F.lit(0.0)), F.lit(1.0))
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(unbiased)


def _longs(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<long>")


def _with_block(df: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """df and keys, each with columns key and _tie, a hash, with _block: blocks are in the
    order of descending key, nulls last, then of _tie.

    Between two successive quantiles of the keys lies a block. A key that is several quantiles
    itself has blocks of its own, as many, by its rows' hashes; so have nulls. Keys are only
    compared, so any long may be one."""
    n = keys.count()
    many = min(sqrt_blocks(n, 4), MOST_BLOCKS)
    shares = [k / many for k in range(1, many)] or [0.5]
    found = keys.agg(F.percentile_approx(key, shares, 4 * many).alias("q"), F.count_if(F.col(key).isNull()).alias("nulls")).first()
    times: dict[int, int] = {}
    for q in sorted(found["q"] or [0], reverse=True):
        times[q] = times.get(q, 0) + 1
    borders, nulls = _longs(list(times)), 1 + many * found["nulls"] // max(1, n)
    begins = [0]  # the block of keys between a border and the one above; then come the border's own
    for m in times.values():
        begins.append(begins[-1] + 1 + m)
    # How many borders are above the key: every width-th one is asked first, then those between.
    width = math.isqrt(len(times)) + 1
    above = lambda values: F.size(F.filter(values, lambda b: b > F.col(key)))
    steps = above(_longs(list(times)[::width]))
    between = above(F.slice(borders, F.greatest(F.col("_steps") - 1, F.lit(0)) * width + 1, F.lit(width)))
    # A share of m by the upper bits of the hash.
    part = lambda m: F.shiftright((F.shiftright("_tie", 32) + (1 << 31)) * m, 32)
    own = F.when(F.get(borders, F.col("_above")) == F.col(key), 1 + part(F.get(_longs(list(times.values())), F.col("_above")))).otherwise(0)
    block = F.when(F.col(key).isNull(), begins[-1] + 1 + part(F.lit(nulls))).otherwise(F.get(_longs(begins), F.col("_above")) + own)

    def of(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("_steps", steps).withColumn("_above", F.when(F.col("_steps") > 0, (F.col("_steps") - 1) * width + between).otherwise(0))
        return rows.withColumn("_block", block.cast("long")).drop("_steps", "_above")

    return of(df), of(keys)


def with_next(df: DataFrame, key: str, ties: list[str], carried: dict[str, str], keys: DataFrame | None = None) -> DataFrame:
    """df with columns of the next row in the order of descending key (nulls last, ties in
    the order of a hash of the columns named, then of these); after the last row comes the
    first. carried maps columns to the names they get. keys has key and ties alone, where df
    is dear to compute.

    Rows go into blocks of the order. The first row of each block is also sent to the block
    before it, so that each block finds its successors by itself and no task holds the whole
    order. There are about 4 * sqrt(rows) blocks, a few times MOST_BLOCKS at most; their first
    rows are the one table that is broadcast."""
    tie = F.xxhash64(*ties)
    small = (df if keys is None else keys).select(key, tie.alias("_tie"))
    rows, small = _with_block(df.withColumn("_tie", tie), small, key)
    # Of the order's hashes the complement falls as they rise.
    firsts = small.groupBy("_block").agg(F.max(F.struct(key, F.bitwise_not("_tie").alias("tie"))).alias("first"))
    around = Window.orderBy("_block")  # over a row for each block
    firsts = firsts.withColumns({"_to": F.lag("_block").over(around), "_last": F.max("_block").over(Window.partitionBy())})
    firsts = firsts.select(F.col("_block").alias("_of"), F.col(f"first.{key}").alias("_key"), F.bitwise_not("first.tie").alias("_key_tie"), F.coalesce("_to", "_last").alias("_to"))
    first = (F.col("_block") == F.col("_of")) & (F.col("_tie") == F.col("_key_tie")) & F.col(key).eqNullSafe(F.col("_key"))
    rows = rows.join(F.broadcast(firsts), first, "left").drop("_of", "_key", "_key_tie")
    both = F.array(F.struct(F.col("_block").alias("at"), F.lit(True).alias("own")), F.struct(F.col("_to").alias("at"), F.lit(False).alias("own")))
    rows = rows.withColumn("_place", F.explode(F.filter(both, lambda p: p["at"].isNotNull()))).withColumns({"_at": F.col("_place.at"), "_own": F.col("_place.own")})
    own = Window.partitionBy("_at").orderBy(F.col("_own").desc(), F.col(key).desc_nulls_last(), "_tie", *ties)
    rows = rows.withColumns({name: F.lead(c).over(own) for c, name in carried.items()})
    return rows.filter("_own").drop("_tie", "_block", "_to", "_place", "_at", "_own")


def op8_one_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts. Null text: empty. Rows
    of one doc_id follow each other in the order of a hash of their texts, then of these."""
    docs = documents(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    printed = add_fingerprint(docs, "text", "fingerprint")
    rows = with_next(printed, "doc_id", ["text"], {"text": "_next", "fingerprint": "_next_fingerprint"}, docs)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("_next"), F.lit(1), half))
    rows = _kept(rows.withColumn("n_chars", n.cast("long")), "_edited", edited)
    rows = add_fingerprint(rows.drop("_next", "text"), "_edited", "edited_fingerprint")
    return rows.select("doc_id", "n_chars", F.sha2("_edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("_next_fingerprint")).alias("near_next"))
