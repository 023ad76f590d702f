"""Document fingerprints: threshold-scaled sketches of word shingles, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitgraph.llm.common import WHITE, durable

WIDTH = 5
#: One shingle hash in SCALE is retained: those below 2^63 / (SCALE / 2), counted from the smallest long.
SCALE = 4


def words(text: Column) -> Column:
    """The words of ``text`` in lower case; null and blank texts have none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), WHITE), lambda w: w != "")


def limit_of(scale: int) -> int:
    return -(2**63) + 2**64 // scale


def sketch(text: Column, width: int = WIDTH, scale: int = SCALE) -> Column:
    """Sorted distinct hashes of the ``width``-word shingles of ``text`` that lie in the lowest 1/``scale`` of all longs.

    A fixed threshold, so sketches of any two documents merge and compare as plain sets. Where no hash lies below it
    (a text of very few shingles), the lowest one stands in. A text of fewer than ``width`` words is one shingle; a
    text without words has an empty sketch.
    """

    def retained(h: Column) -> Column:
        low = F.filter(h, lambda x: x < limit_of(scale))
        return F.when(F.size(low) > 0, low).otherwise(F.slice(F.array_sort(h), 1, 1))

    hashes = lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - width + 1, F.lit(1))), lambda i: F.xxhash64(F.slice(w, i, width)))
    of = F.transform(F.array(words(text)), lambda w: F.when(F.size(w) > 0, hashes(w)).otherwise(F.expr("cast(array() as array<bigint>)")))
    return F.array_sort(F.array_distinct(F.transform(of, retained)[0]))


def text_form(s: Column) -> Column:
    """A sketch as text: hexadecimal hashes, comma-joined."""
    return F.array_join(F.transform(s, lambda h: F.lower(F.hex(h))), ",")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness of two sketches: shared over all retained hashes; two empty ones (no words) are alike."""
    shared = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - shared
    return F.when(total == 0, 1.0).otherwise(shared / total).cast("double")


def containment(a: Column, b: Column) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has, for documents of very unequal length; 0 if ``a`` retained none."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a)).otherwise(0.0)


def merge(a: Column, b: Column, scale: int = SCALE) -> Column:
    """The sketch of both documents' shingles together; a stand-in above the threshold stays only if nothing else does."""

    def kept(h: Column) -> Column:
        low = F.filter(h, lambda x: x < limit_of(scale))
        return F.when(F.size(low) > 0, low).otherwise(F.slice(h, 1, 1))

    return F.transform(F.array(F.array_sort(F.array_union(a, b))), kept)[0]


def fingerprint(docs: DataFrame, text_col: str = "text", width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """``docs`` with ``sketch`` (array<bigint>; a column of that name is replaced). Row by row, without a shuffle."""
    return docs.withColumn("sketch", sketch(F.col(text_col), width, scale))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_per_block: int = 1024, max_blocks: int = 65536) -> DataFrame:
    """(doc_id, text, next_text): the text of the row that follows by descending id, and the first one's after the last.

    Ids are cut into blocks of about ``rows_per_block`` rows at approximate quantiles (at most ``max_blocks`` bounds of
    8 bytes, one array), so texts are shuffled once, to a window inside each block. Only the blocks'
    edge rows travel further: each block's last row takes the first row of the next lower block. An id that spans
    several quantiles is split among its blocks by a hash of the text. Equal ids are ordered by that hash, then by text;
    null ids come last, likewise; null texts are kept as such, being empty. Other columns stay out.
    """
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    n, nulls = d.agg(F.count("doc_id"), F.count_if(F.col("doc_id").isNull())).first()
    blocks, rest = max(1, min(max_blocks, -(-n // rows_per_block))), max(1, min(max_blocks, -(-nulls // rows_per_block)))
    cuts = d.agg(F.array_sort(F.coalesce(F.percentile_approx("doc_id", [i / blocks for i in range(1, blocks)] or [0.5], max(10_000, 4 * blocks)), F.expr("array(0L)"))).alias("cuts"))
    steps = F.lit([2**k for k in reversed(range(blocks.bit_length() + 1))])

    def below(value: Column, same: bool) -> Column:
        """How many cuts are less than ``value``, or no more than it, by halving steps."""
        at = lambda i: F.try_element_at("cuts", i)
        fits = lambda i: F.coalesce(at(i) <= value if same else at(i) < value, F.lit(False))
        return F.aggregate(steps, F.lit(0), lambda low, step: F.when(fits((low + step).cast("int")), (low + step).cast("int")).otherwise(low))

    salt = F.xxhash64(F.coalesce("text", F.lit("")))
    d = d.withColumn("cuts", durable(cuts).scalar()).withColumn("high", below(F.col("doc_id"), True)).withColumn("share", F.greatest(F.col("high") - below(F.col("doc_id"), False), F.lit(1)))
    block = F.when(F.col("doc_id").isNull(), -1 - F.pmod(salt, F.lit(rest))).otherwise(F.col("high") - F.pmod(salt, F.col("share"))).cast("int")
    d = d.select("doc_id", "text", block.alias("block"))
    inside = d.select("*", F.expr("lead(struct(text)) over (partition by block order by doc_id desc nulls last, text desc nulls last)").alias("ahead"))
    edge = d.groupBy("block").agg(F.max(F.struct(F.coalesce("doc_id", F.lit(-(2**63))).alias("i"), F.col("text").isNotNull().alias("k"), "text")).alias("top"))
    edge = durable(edge.select("block", F.struct(F.col("top.text")).alias("first")))
    turn = Window.partitionBy(F.lit(0)).orderBy(F.desc("block"))  # block numbers alone, at most two for each bound
    names = edge.select("block")
    after = names.select("block", F.coalesce(F.lead("block").over(turn), F.first("block").over(turn)).alias("to"))
    follow = durable(after.join(edge.withColumnRenamed("block", "to"), "to").select("block", "first"))
    return inside.join(follow, "block").select("doc_id", "text", F.coalesce("ahead", "first")["text"].alias("next_text"))


def op5_fingerprints(spark, sf_dir):
    docs = with_next(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    text, follow = F.coalesce("text", F.lit("")), F.coalesce("next_text", F.lit(""))
    d = docs.select("doc_id", text.alias("text"), follow.alias("next"), F.length(text).cast("long").alias("n_chars"))
    cut = (F.col("n_chars") / 3).cast("int")
    d = d.withColumn("edited", F.concat(F.left("text", F.col("n_chars").cast("int") - cut), F.left("next", cut)))
    d = d.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.array(F.struct(sketch(F.col("text")).alias("a"), sketch(F.col("edited")).alias("b"), sketch(F.col("next")).alias("c"))).alias("x"))
    return d.select("doc_id", "n_chars", "edited_sha256", F.inline("x")).select("doc_id", "n_chars", "edited_sha256", text_form(F.col("a")).alias("fingerprint"), text_form(F.col("b")).alias("edited_fingerprint"), likeness(F.col("a"), F.col("b")).alias("near_edited"), likeness(F.col("a"), F.col("c")).alias("near_next"))
