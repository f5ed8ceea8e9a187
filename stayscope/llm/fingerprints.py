"""Document fingerprints: a Merkle tree over paragraphs and sections (dealt
operator 8, DataFrame functions only).

Leaves are a paragraph's pieces (sentences, at most ``PIECE`` characters),
digested to 32 bits with their length; a paragraph is the list of its leaves;
a section is a run of paragraphs that ends where a paragraph's digest is 0 mod
8, so an edit moves no boundary but its own; a section's digest covers its
paragraphs and the root (SHA-256) covers the full MD5 digests of all
paragraphs.  The fingerprint is that tree as a string:

    root#section:leaf.leaf;leaf;|section:...

with leaf = 8 hex digits and the length in 2, ``;`` after a paragraph and ``|``
after a section.  Equal texts have equal fingerprints, equal roots mean equal
texts, and comparing two trees from the root down names the sections,
paragraphs and leaves that differ (``locate_edits``).

Likeness (0 to 1) of two fingerprints: twice the characters in leaves that
both hold, over the characters in the leaves of each; 1 for equal roots.

Edge cases: null and empty texts have one empty paragraph and are alike;
texts of white space keep it in their leaves; very long texts are processed
whole; rows of one id share the next document, of the rows with the next lower id
the one with the least beginning (null ids come last); an empty table gives an empty result; only
the id and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import stored

PIECE = 120
_PIECES = rf"[^.!?]{{1,{PIECE}}}[.!?]{{0,60}}|[.!?]{{1,60}}"


def _hex2(n: Column) -> Column:
    return F.lpad(F.lower(F.hex(n.cast("long"))), 2, "0")


def fingerprint(text: Column) -> Column:
    """Fingerprint string of a text."""
    paragraphs = F.split(F.coalesce(text, F.lit("")), "\n", -1)

    def paragraph(p):
        leaves = F.array_join(F.transform(F.regexp_extract_all(p, F.lit(_PIECES), F.lit(0)), lambda x: F.concat(
            F.substring(F.md5(x), 1, 8), _hex2(F.length(x)))), ".")
        return F.struct(leaves.alias("leaves"), F.md5(p).alias("digest"))

    def tree(ps):
        body = F.array_join(F.transform(ps, lambda x: F.concat(
            x["leaves"], F.lit(";"), F.when(F.substring(x["digest"], 1, 1).isin("0", "8"), "|").otherwise(""))), "")
        sections = F.array_join(F.transform(F.split(body, r"\|"), lambda s: F.concat(
            F.substring(F.md5(s), 1, 8), F.lit(":"), s)), "|")
        root = F.sha2(F.array_join(F.transform(ps, lambda x: x["digest"]), ""), 256)
        return F.concat(root, F.lit("#"), sections)

    return F.transform(F.array(F.transform(paragraphs, paragraph)), tree)[0]


def root(fp: Column) -> Column:
    return F.substring_index(fp, "#", 1)


def sections(fp: Column) -> Column:
    """Array of (digest, paragraphs) of a fingerprint."""
    return F.transform(F.split(F.substring_index(fp, "#", -1), r"\|"), lambda s: F.struct(
        F.substring_index(s, ":", 1).alias("digest"), F.substring_index(s, ":", -1).alias("paragraphs")))


def leaves(fp: Column) -> Column:
    """Distinct leaves of a fingerprint (8 hex digits and the length in 2)."""
    flat = F.regexp_replace(F.substring_index(fp, "#", -1), r"[0-9a-f]{8}:", "")
    return F.array_distinct(F.array_remove(F.split(flat, r"[.;|]+"), ""))


def _chars(found: Column) -> Column:
    return F.aggregate(found, F.lit(0).cast("long"), lambda a, x: a + F.conv(F.substring(x, 9, 2), 16, 10).cast("long"))


def likeness(fp_a: Column, fp_b: Column) -> Column:
    """Share of the two fingerprints' leaf characters that both hold."""
    bound = F.array(F.struct(leaves(fp_a).alias("a"), leaves(fp_b).alias("b")))
    share = F.transform(bound, lambda x: F.struct(
        _chars(F.array_intersect(x["a"], x["b"])).alias("both"),
        (_chars(x["a"]) + _chars(x["b"])).alias("sum")))[0]
    ratio = F.transform(F.array(share), lambda s: F.when(
        s["sum"] > 0, 2 * s["both"] / s["sum"]).otherwise(F.lit(0.0)))[0]
    return F.when(root(fp_a) == root(fp_b), F.lit(1.0)).when(
        fp_b.isNull() | fp_a.isNull(), F.lit(0.0)).otherwise(F.least(ratio, F.lit(1.0)))


def locate_edits(fp_a: Column, fp_b: Column) -> Column:
    """Sections of ``a`` that ``b`` does not hold, as (section, leaves that
    differ); empty where the roots are equal."""
    other = F.transform(sections(fp_b), lambda s: s["digest"])
    held = leaves(fp_b)
    numbered = F.transform(sections(fp_a), lambda s, i: F.struct(
        i.alias("section"), s["digest"].alias("digest"), F.array_except(
            F.array_remove(F.split(s["paragraphs"], r"[.;]+"), ""), held).alias("leaves")))
    differing = F.filter(numbered, lambda s: ~F.array_contains(other, s["digest"]))
    return F.when(root(fp_a) == root(fp_b), F.slice(differing, 1, 0)).otherwise(differing)


def next_documents(docs: DataFrame) -> DataFrame:
    """(id, next_id) over the distinct ids, descending with null last; after
    the last comes the first.

    Ids are dealt into ranges by sampled bounds and chained inside each range;
    the ranges' ends, one row each, are chained by a window over them."""
    ids = docs.select("id").distinct()
    n = ids.count()
    if n == 0:
        return ids.withColumn("next_id", F.col("id"))
    from pyspark.sql import Window
    parts = max(1, -(-n // 100_000))
    ranged = stored(ids.repartitionByRange(parts, F.col("id").desc_nulls_last())
                    .withColumn("part", F.spark_partition_id()), "ids")
    order = F.col("id").desc_nulls_last()
    inner = Window.partitionBy("part").orderBy(order)
    chained = ranged.select("id", "part", F.lead(F.struct("id")).over(inner).alias("next"))
    heads = ranged.groupBy("part").agg(F.max_by(F.struct("id"), F.struct(F.col("id").isNotNull(), "id")).alias("head"))
    across = Window.orderBy("part")                          # one row a range of 100,000 ids
    everything = across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("part", F.coalesce(F.lead("head").over(across), F.first("head").over(everything)).alias("after"))
    return (chained.join(heads, "part")
            .select("id", F.coalesce("next", "after")["id"].alias("next_id")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: (id, n_chars, fingerprint, edited, edited_fingerprint,
    near_edited, near_next); edited replaces the last half of the text by as
    many characters of the next document's beginning."""
    d = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    need = (d.groupBy("id").agg(F.floor(F.max(F.length("text")) / 2).cast("int").alias("need"))
            .withColumnRenamed("id", "need_id"))
    after = (next_documents(d).join(need, F.col("id").eqNullSafe(F.col("need_id")), "left")
             .select(F.xxhash64("next_id").alias("k"), F.col("id").alias("for_id"), "next_id", "need"))
    # one exchange of the texts, by a hash of the id that is never null, serves
    # as next documents and as documents; of the former only beginnings move on
    base = d.select(F.xxhash64("id").alias("k"), "id", "text").repartition("k")
    def same(a, b):      # equality as a filter: as a join key it would cost another exchange
        a, b = F.col(a), F.col(b)
        return ((a <= b) & (a >= b)) | (a.isNull() & b.isNull())

    after = (base.join(after, "k").where(same("id", "next_id"))
             .select(F.xxhash64("for_id").alias("k"), "for_id",
                     F.struct(F.expr("substring(text, 1, need)").alias("head"),
                              fingerprint(F.col("text")).alias("fp")).alias("m"))
             .repartition("k").groupBy("k", F.struct("for_id").alias("f")).agg(F.min("m").alias("m")))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    j = (base.join(after, "k", "left").where(F.col("f").isNull() | same("id", "f.for_id"))
         .select("id", n.alias("n"), "text", F.col("m.fp").alias("next_fp"), F.concat(
             F.substring(F.col("text"), F.lit(1), n - half),
             F.substring(F.coalesce("m.head", F.lit("")), F.lit(1), half)).alias("edited")))
    j = j.select("id", "n", "edited", "next_fp", fingerprint(F.col("text")).alias("fp"),
                 fingerprint(F.col("edited")).alias("efp"))
    return j.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_chars"),
                    F.col("fp").alias("fingerprint"), "edited", F.col("efp").alias("edited_fingerprint"),
                    likeness(F.col("fp"), F.col("efp")).alias("near_edited"),
                    likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
