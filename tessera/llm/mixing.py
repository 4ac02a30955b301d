"""Mixing sources to target weights with DataFrame functions only.

Tokens of a source are laid end to end in a pseudorandom document order and packed into
blocks of ``block`` tokens. The slots that a source's target pays for are thrown at the
output shards by hash, which draws each shard's source counts multinomially while every
source's total stays exact. Slot k of a source maps through a pseudorandom index permutation
(an affine map modulo the number of full blocks) to a block, and slots join blocks by
(source, index). A pass over a source ends with its one short block; the next pass permutes anew.
The last slot of a source takes only the words still missing, so the words taken equal the
target rounded down and no word is taken more often than passes were begun (at most ``max_repeat``).

Document order: 4096 hash buckets a source, each ordered by hash and id, so prefix sums are
one window per bucket and one over bucket totals; no source is ever in one task.

Edge cases: null or empty texts have size 0 and are taken 0 times; the null source is a
source, ranked last; ids may be null or repeated (each row has its own range of tokens); sources of
size 0 get target 0; a text of any length is a range of tokens, cut at blocks, and a very long one is
split before its pieces are shuffled; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import WORD_RE, stash

BLOCK_TOKENS = 256
SLOTS_PER_SHARD = 1024
BUCKETS = 4096
#: Primes above any number of blocks a source can have; none divides it, so each gives a bijection.
PERMUTATION_PRIMES = (2**59 - 55, 2**60 - 93, 2**61 - 1, 2**62 - 57)


def text_size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def document_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    return docs.select(
        docs[id_col].alias("id"), docs[source_col].cast("string").alias("source"),
        text_size(docs[text_col]).alias("size"), F.xxhash64(docs[text_col]).alias("text_hash"), docs[text_col].alias("text"))


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, max_repeat: int) -> DataFrame:
    """One row per source: s (rank by code point, null last), source, source_size,
    weight, target. The water level solves sum(min(cap, weight * level)) = share * all
    in one ordered pass, which is where repeated resharing of the excess ends.
    The unpartitioned windows run over sources, not documents."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("s", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("s", F.lit(len(weights))) + 1)
    per = per.withColumn("weight", weight).withColumn("cap", F.col("source_size").cast("double") * max_repeat)
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), "s")
    before = F.coalesce(F.sum("cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing))
    everything = by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = per.withColumn("level", (F.sum("source_size").over(everything) * share - before) / after)
    level = F.greatest(F.max("level").over(everything), F.lit(0.0))
    return levels.select("s", "source", "source_size", "weight", F.least("cap", F.col("weight") * level).alias("target"))


def place_documents(docs: DataFrame, sizes: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """``docs`` (id, source, size, text_hash and anything more) with s, source_size,
    target and start: the document's first token in its source."""
    def bucketed(df: DataFrame) -> DataFrame:
        order = F.xxhash64(F.lit(seed), "id", "text_hash")
        keyed = df.withColumn("ord", order).withColumn("bucket", F.pmod("ord", F.lit(BUCKETS)))
        keyed = keyed.withColumnRenamed("source", "doc_source")
        return keyed.join(sources, keyed.doc_source.eqNullSafe(sources.source)).drop("doc_source")

    totals = bucketed(sizes).groupBy("s", "bucket").agg(F.sum("size").alias("in_bucket"))
    upto = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("s", "bucket", F.coalesce(F.sum("in_bucket").over(upto), F.lit(0)).alias("base"))
    inside = Window.partitionBy("s", "bucket").orderBy("ord", F.col("id").asc_nulls_last(), "text_hash", "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    return bucketed(docs).join(bases, ["s", "bucket"]).withColumn(
        "start", F.col("base") + F.coalesce(F.sum("size").over(inside), F.lit(0))).drop("ord", "bucket", "base")


def _div(a: Column, b: Column | int) -> Column:
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b).cast("long"))


def block_pieces(placed: DataFrame, block: int) -> DataFrame:
    """One row per document and block it touches; documents of size 0 keep one row without a block. If
    there are texts, each row gets its own words only, joined by spaces: the text is split once per document and not copied per block."""
    start, end = F.col("start"), F.col("start") + F.col("size")
    blocks = F.when(F.col("size") > 0, F.sequence(_div(start, block), _div(end - 1, block)))
    first = lambda b: F.greatest(start, b * block)
    n = lambda b: F.least(end, (b + 1) * block) - first(b)
    fields = lambda b: [b.alias("block"), first(b).alias("first"), n(b).alias("n")]
    if "text" in placed.columns:
        words = F.regexp_extract_all("text", F.lit(f"({WORD_RE})"), 1)
        placed = placed.withColumn("words", F.explode(F.array(words))).drop("text")  # evaluated once, not again inside the lambda
        text = lambda b: F.array_join(F.slice("words", (first(b) - start + 1).cast("int"), n(b).cast("int")), " ")
        pieces = F.transform(blocks, lambda b: F.struct(*fields(b), text(b).alias("text")))
    else:
        pieces = F.transform(blocks, lambda b: F.struct(*fields(b)))
    kept = [c for c in placed.columns if c != "words"]
    return placed.select(*kept, F.explode_outer(pieces).alias("piece")).select(*kept, "piece.*")


def draw_slots(sources: DataFrame, block: int, seed: int, slots_per_shard: int) -> DataFrame:
    """(shard, slot, s, block, take): every slot of every output shard, the block
    it reads and how many of the block's tokens it takes."""
    want = sources.where(F.col("source_size") > 0).select(
        "s", "source_size", F.floor("target").alias("want"), _div(F.col("source_size") + block - 1, block).alias("m"))
    passes = _div(F.col("want") + F.col("source_size") - 1, F.col("source_size"))
    want = want.where(F.col("want") > 0).withColumn("slots", passes * F.col("m"))
    all_slots = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shards = (_div(F.sum(_div(F.col("want"), block)).over(all_slots), slots_per_shard) + 1)
    want = want.withColumn("shards", shards)
    chunk = 4096
    chunks = want.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), _div(F.col("slots") - 1, chunk))))
    # a fixed number of tasks: measured before the explode, the chunks look too small to spread
    chunks = chunks.repartition(int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions")), "s", "chunk")
    k = F.explode(F.sequence(F.col("chunk") * chunk, F.least(F.col("slots"), (F.col("chunk") + 1) * chunk) - 1)).alias("k")
    slots = chunks.select("s", "source_size", "want", "m", "shards", k)
    slots = slots.withColumn("round", _div(F.col("k"), F.col("m"))).withColumn("j", F.pmod("k", "m"))
    full = F.col("m") - 1
    modulus = F.greatest(full, F.lit(1).cast("long"))
    prime = F.element_at(F.array(*[F.lit(p) for p in PERMUTATION_PRIMES]), F.pmod(F.xxhash64(F.lit(seed), "s", "round"), F.lit(len(PERMUTATION_PRIMES))).cast("int") + 1)
    step, shift = F.pmod(prime.cast("long"), modulus), F.pmod(F.xxhash64(F.lit(seed + 1), "s", "round"), modulus)
    moved = ((step.cast("decimal(19,0)") * F.col("j").cast("decimal(19,0)") + shift.cast("decimal(19,0)")) % modulus.cast("decimal(19,0)")).cast("long")
    target_block = F.when(F.col("j") == full, full).otherwise(moved)
    length = F.least(F.lit(block).cast("long"), F.col("source_size") - target_block * block)
    done = F.col("round") * F.col("source_size") + F.col("j") * block
    slots = slots.withColumn("block", target_block).withColumn("take", F.least(length, F.col("want") - done))
    shard = F.pmod(F.xxhash64(F.lit(seed + 2), "s", "k"), F.col("shards"))
    return slots.where(F.col("take") > 0).select(shard.alias("shard"), F.col("k").alias("slot"), "s", "block", "take")


def mix(docs: DataFrame, weights: Sequence[float], share: float, max_repeat: int = 2, block: int = BLOCK_TOKENS, seed: int = 17,
        slots_per_shard: int = SLOTS_PER_SHARD, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        with_text: bool = True) -> DataFrame:
    """The mix as pieces: s, source, source_size, target, id, size, start, shard, slot, block,
    first (token of the piece within the document), n (tokens) and, if ``with_text``, the piece's
    words joined by spaces. Documents of which nothing is taken keep one row with n = 0 and no shard."""
    narrow = document_sizes(docs, id_col, text_col, source_col)
    sizes = stash(narrow.drop("text"), "mix-sizes")
    sources = stash(source_targets(sizes, weights, share, max_repeat), "mix-sources")
    pieces = block_pieces(place_documents(narrow if with_text else sizes, sizes, sources, seed), block)
    slots = draw_slots(sources, block, seed, slots_per_shard)
    # the planner measures slots before they are exploded, so it must not choose to broadcast them
    mixed = pieces.join(slots.hint("merge"), ["s", "block"], "left")
    n = F.greatest(F.least(F.col("n"), F.col("block") * block + F.col("take") - F.col("first")), F.lit(0).cast("long"))
    drawn = F.when(F.col("take").isNotNull(), n).otherwise(F.lit(0).cast("long"))
    mixed = mixed.withColumn("whole", F.col("n")).withColumn("n", F.coalesce(drawn, F.lit(0).cast("long")))
    mixed = mixed.withColumn("first", F.col("first") - F.col("start"))
    columns = ["s", "source", "source_size", "target", "id", "size", "start", "shard", "slot", "block", "first", "n"]
    if not with_text:
        return mixed.select(columns)
    cut = F.array_join(F.slice(F.split("text", " "), 1, F.col("n").cast("int")), " ")  # the last slot of a source may take less
    return mixed.select(*columns, F.when(F.col("n") == F.col("whole"), F.col("text")).when(F.col("n") > 0, cut).alias("text"))


def taken_words(pieces: DataFrame) -> DataFrame:
    """One row per document: id, size, source_size, target, taken. Documents of
    size 0 share a start; equal rows among them are counted and written out again."""
    by_doc = pieces.groupBy("s", "start", "size", "id", "source_size", "target")
    taken = by_doc.agg(F.sum("n").alias("taken"), F.count("*").alias("n_rows"))
    copies = F.sequence(F.lit(1).cast("long"), F.when(F.col("size") == 0, F.col("n_rows")).otherwise(1))
    return taken.withColumn("copy", F.explode(copies)).select("id", "size", "source_size", "target", "taken")
