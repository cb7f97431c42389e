"""Line dedup with a log-template tree, in DataFrame functions only.

A line that stands in two documents or more with the very same tokens is a template of constants only, whatever its
length and script; it recurs.  Lines of at least ``MIN_TOKENS`` tokens are also parsed into a tree of fixed depth: first by
their number of tokens, then by their ``DEPTH`` leading tokens, tokens with a digit counting as variable.  In a
leaf that ``MIN_DOCS`` documents share, the fields are generalised: a token stays in the template if
at least ``MIN_DOCS`` of the leaf's (document, distinct line) pairs and at least one in ``LEAF_SHARE`` of them have it at its
place, otherwise it becomes a variable field; so a field generalises alike in small and in crowded leaves.  A
template recurs when lines of at least ``MIN_DOCS`` documents have it and at least ``CONSTANT`` of its tokens
behind the leading ones are constant.  The lines of a recurring template are dropped from every document but the one with the smallest id.

Leaves, tokens and templates are counted with partial sums, and lines meet their leaf and
template in equi-joins whose other side is one written row per key, so adaptive
execution can split a crowded leaf.

Defined cases: null texts stay null and have no lines; blank lines, and documents without an id,
neither count nor lose anything; equal lines are found by 96 bits of hashes; rows with the same id are the
same document when counting, and each loses its own lines; other columns pass through,
except those named like an output column, which the output replaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

DEPTH = 3
MIN_TOKENS = 4
MIN_DOCS = 3
LEAF_SHARE = 50
CONSTANT = 0.6
VARIABLE = "<*>"
FILTER_BITS = 1 << 23
_BLOCK_BITS = 32_768  # of one bitmap, fixed by bitmap_construct_agg

_KEY = ["doc_id", "mark"]
# A token that has a digit; only starts of tokens are tried.
_DIGIT_TOKEN = r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+"


def _spaced(raw: Column) -> Column:
    """The line with single spaces; only lines with other white space are rewritten."""
    odd = [F.contains(raw, F.lit(x)) for x in ("  ", "\t", "\x0b", "\x0c", "\r")]
    odd = odd[0] | odd[1] | odd[2] | odd[3] | odd[4]
    return F.trim(F.when(odd, F.regexp_replace(raw, r"[\x09\x0B-\x0D ]+", " ")).otherwise(raw))


def _masked(line: Column) -> Column:
    return F.regexp_replace(line, _DIGIT_TOKEN, VARIABLE)


def drop_recurring(docs: DataFrame, min_docs: int = MIN_DOCS, depth: int = DEPTH, min_tokens: int = MIN_TOKENS, constant: float = CONSTANT) -> DataFrame:
    """``docs`` with recurring lines taken out of ``text``, and ``n_lines`` and ``n_dropped``."""
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    marked = docs.select(*[c for c in names if c != "text"], F.xxhash64("text").alias("__mark"), F.split("text", "\n").alias("__lines"))
    dropped = _repeated(docs).unionByName(_dropped(docs, min_docs, depth, min_tokens, constant))
    dropped = dropped.groupBy(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark")).agg(F.collect_set("line_no").alias("__gone"))
    same = (marked["doc_id"] == dropped["__id"]) & (marked["__mark"] == dropped["__mark"])
    whole = marked.join(dropped, same, "left")
    n_lines = F.when(F.col("__lines").isNull(), 0).otherwise(F.size("__lines"))
    # Numbers of the lines that stay; "__lines" is a column of the join, not split anew per line.
    stay = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__gone"))
    kept = F.array_join(F.transform(stay, lambda i: F.get(F.col("__lines"), i)), "\n")
    text = F.when(F.col("__gone").isNull(), F.array_join("__lines", "\n")).otherwise(kept)
    out = [text.alias("text") if c == "text" else F.col(c) for c in names]
    n_dropped = F.coalesce(F.size("__gone"), F.lit(0))
    n_dropped = F.when(F.col("__gone").isNull(), 0).otherwise(n_dropped)
    return whole.select(*out, n_lines.cast("long").alias("n_lines"), n_dropped.cast("long").alias("n_dropped"))


def _repeated(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, line_no) of all lines that a document with a smaller id has as well."""
    spaced = F.transform(F.split("text", "\n"), lambda raw, i: F.struct(i.alias("line_no"), _spaced(raw).alias("line")))
    keyed = F.transform(F.filter(spaced, lambda p: p["line"] != ""), lambda p: F.struct(p["line_no"], _same(p["line"]).alias("same")))
    lines = docs.filter("doc_id is not null").select("doc_id", F.xxhash64("text").alias("mark"), F.inline(keyed))
    owners = lines.groupBy("same").agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("last"))
    recurring = cut_lineage(owners.filter("keeper < last").select("same", "keeper"))
    return _perhaps_in(lines, recurring, "same").join(recurring, "same").filter("doc_id > keeper").select(*_KEY, "line_no")


def _same(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.hash(line).alias("b"))


def _dropped(docs: DataFrame, min_docs: int, depth: int, min_tokens: int, constant: float) -> DataFrame:
    """(doc_id, mark, line_no) of all lines to drop."""
    # Parsed inside the array, so that each line is worked out once before it becomes a row.
    raw = F.split("text", "\n")
    parsed = F.transform(F.transform(raw, _spaced), lambda line, i: F.struct(i.alias("line_no"), line.alias("line"), F.size(F.split(line, " ")).alias("n")))
    long_enough = F.filter(parsed, lambda p: (p["line"] != "") & (p["n"] >= min_tokens))
    leaf = lambda p: F.concat_ws(" ", p["n"].cast("string"), _masked(F.substring_index(p["line"], " ", depth)))
    leafed = F.transform(long_enough, lambda p: F.struct(p["line_no"].alias("line_no"), p["line"].alias("line"), leaf(p).alias("leaf")))
    lines = docs.filter("doc_id is not null").select("doc_id", F.xxhash64("text").alias("mark"), F.inline(leafed))
    leaves = lines.groupBy("leaf").agg(F.count_distinct("doc_id").alias("docs")).filter(F.col("docs") >= min_docs).select("leaf")
    leaves = cut_lineage(leaves)
    # Lines of shared leaves, with the id of their masked form; most others go before the shuffle.
    shared = _perhaps_in(lines, leaves).join(leaves, "leaf", "left_semi").withColumn("masked", _masked(F.col("line")))
    shared = cut_lineage(shared.select(*_KEY, "line_no", "leaf", "masked", F.md5(F.concat_ws(" ", "leaf", "masked")).alias("variant")))
    pairs = shared.select("variant", "doc_id").distinct()
    variants = shared.groupBy("variant").agg(F.min("leaf").alias("leaf"), F.min("masked").alias("masked"))
    counts = pairs.groupBy("variant").agg(F.count(F.lit(1)).alias("pairs"))
    variants = cut_lineage(variants.join(counts, "variant"))
    templates = _templates(variants, min_docs, depth, constant)
    support = pairs.join(templates, "variant").groupBy("template").agg(F.count_distinct("doc_id").alias("docs"), F.min("doc_id").alias("keeper"))
    recurring = templates.join(support.filter(F.col("docs") >= min_docs), "template").select("variant", "keeper")
    return shared.join(cut_lineage(recurring), "variant").filter("doc_id > keeper").select(*_KEY, "line_no")


def _perhaps_in(lines: DataFrame, leaves: DataFrame, key: str = "leaf") -> DataFrame:
    """Lines whose key's hash is set in a bitmap of all keys of ``leaves``; the bitmap has ``FILTER_BITS`` bits whatever the data.

    A scalar subquery instead of a join: the semi join that follows would be moved below a join.
    """
    bit = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    block, place = F.floor(bit / _BLOCK_BITS).cast("int"), bit % _BLOCK_BITS
    bits = leaves.groupBy(block.alias("block")).agg(F.bitmap_construct_agg(place).alias("bits"))
    blocks = lines.sparkSession.range(FILTER_BITS // _BLOCK_BITS).select(F.col("id").cast("int").alias("block")).join(bits, "block", "left")
    bitmap = blocks.select(F.array_sort(F.collect_list(F.struct("block", "bits"))).alias("blocks")).scalar()
    own = F.get(bitmap, block)["bits"]
    byte = F.conv(F.hex(F.substring(own, (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return lines.filter(F.getbit(byte, (place % 8).cast("int")) == 1)


def _templates(variants: DataFrame, min_docs: int, depth: int, constant: float) -> DataFrame:
    """(variant, template) for masked lines whose template is constant enough."""
    tokens = variants.select("variant", "leaf", "pairs", F.posexplode(F.split("masked", " ")).alias("at", "token"))
    sizes = variants.groupBy("leaf").agg(F.sum("pairs").alias("leaf_pairs"))
    seen = tokens.filter(F.col("token") != VARIABLE).groupBy("leaf", "at", "token").agg(F.sum("pairs").alias("seen"))
    steady = seen.filter(F.col("seen") >= min_docs).join(sizes, "leaf").filter(F.col("seen") * LEAF_SHARE >= F.col("leaf_pairs"))
    steady = cut_lineage(steady.select("leaf", "at", "token", F.lit(True).alias("steady")))
    field = F.when(F.col("steady"), F.col("token")).otherwise(F.lit(VARIABLE))
    placed = tokens.drop("pairs").join(steady, ["leaf", "at", "token"], "left").groupBy("variant").agg(
        F.array_sort(F.collect_list(F.struct("at", field.alias("field")))).alias("fields"), F.count(F.when(F.col("at") >= depth, F.col("steady"))).alias("constants")
    )
    enough = placed.filter((F.size("fields") > depth) & (F.col("constants") >= (F.size("fields") - depth) * constant))
    return cut_lineage(enough.select("variant", F.md5(F.array_join("fields.field", " ")).alias("template")))
