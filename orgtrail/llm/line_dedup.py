"""Line dedup with a log-template tree of fixed depth.

A line falls through the tree by its number of tokens and its leading tokens, in which
anything with a digit counts as variable, and ends in a leaf. In a leaf that recurs in
documents, lines are reduced to forms: tokens with a digit become variable if at least half of
the tokens are not, else the line stays as it is and only goes where it recurs word for word.
A leaf has several templates: its commonest forms, each with the forms that agree with it in
most of all tokens. A template that recurs in ``min_docs`` documents, or in two if it has more
than 50 tokens, is boilerplate and its lines are dropped from all documents; so is a form that
recurs alone.

Native: column expressions, aggregates and equality joins. A leaf is only ever counted, so a
leaf that holds a third of all lines is combined in each task first.

Edge cases: lines without tokens (also the empty text's only line) are kept and count for
nothing; a null text stays null with 0 lines; a document counts once per template however
often it repeats it; rows that repeat a doc_id count as one document; null ids are one
document; an empty table gives no rows.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orgtrail.llm.common import at_rest, text_or_empty
from orgtrail.operators.sides import Side, maybe_listed, rest

BLANKS = r"[\x20\x09-\x0D]+"
VARIABLE = "<*>"
#: A token with a digit behind its blank, and one that is variable, among tokens with one blank between them.
NUMBERED = r" [^ \d]*+\d[^ ]*"
IS_VARIABLE = r"<\*>(?<![^ ]<\*>)(?![^ ])"
#: Leading tokens that the tree looks at.
DEPTH = 4
#: Documents in which a template must recur; in ``LONG_DOCS`` if it has more than ``LONG`` tokens.
MIN_DOCS = 3
LONG, LONG_DOCS = 50, 2
#: Share of a line's tokens that must be fixed for it to be generalised, and share of all its
#: tokens in which it must agree with its template.
FIXED_SHARE = 0.5
AGREE = 0.8
#: Forms of a bucket that others are compared with in the first round.
SEEDS = 16


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _hash(text: Column) -> Column:
    """128 bits, so that equal means equal at any size.

    Never null, or a join on it would test for null next to the scan and compute it twice.
    """
    return F.coalesce(F.unhex(F.md5(text.cast("binary"))), F.lit(bytearray()))


def _spaced(line: Column) -> Column:
    """The line's tokens with one blank between them, as most lines have them already."""
    # Looked for in bytes: a pattern would decode each line first.
    odd = line.contains("  ")
    for blank in "\t\n\v\f\r":
        odd |= line.contains(blank)
    return F.trim(F.when(odd, F.regexp_replace(line, BLANKS, " ")).otherwise(line))


def _generalised(spaced: Column) -> Column:
    """The tokens, those with a digit variable."""
    return F.ltrim(F.regexp_replace(F.concat(F.lit(" "), spaced), NUMBERED, f" {VARIABLE}"))


def _variables(general: Column) -> Column:
    """How many tokens are variable; most lines have none and are not decoded."""
    return F.when(general.contains(VARIABLE), F.regexp_count(general, F.lit(IS_VARIABLE))).otherwise(0)


def _leaf(spaced: Column, depth: int) -> Column:
    """The leaf of a line of ``n`` tokens: their number and the leading ones, generalised."""
    return _hash(F.concat(F.col("n").cast("string"), F.lit(" "), _generalised(F.substring_index(spaced, " ", depth))))


def parsed_lines(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """One row per line that has tokens: ``doc_id``, ``line``, ``leaf`` and ``n``, its tokens."""
    lines = docs.select("doc_id", F.explode(_lines(text_or_empty(F.col("text")))).alias("line"))
    spaced = lines.filter(F.ltrim(F.col("line"), F.lit(" \t\n\v\f\r")) != "").withColumn("_spaced", _spaced(F.col("line")))
    blanks = F.octet_length("_spaced") - F.octet_length(F.replace(F.col("_spaced"), F.lit(" "), F.lit("")))
    return spaced.withColumn("n", blanks + 1).withColumn("leaf", _leaf(F.col("_spaced"), depth)).drop("_spaced")


def _likely(lines: DataFrame, often: Side) -> DataFrame:
    """The lines of the leaves in ``often``; a bitmap cuts most others where they are read, before the shuffle."""
    return maybe_listed(lines, often, "leaf").join(often.frame, "leaf", "left_semi")


def _enough(docs: Column, min_docs: int) -> Column:
    """Whether so many documents make a line or template of ``n`` tokens boilerplate."""
    return docs >= F.when(F.col("n") > LONG, min(LONG_DOCS, min_docs)).otherwise(min_docs)


def _banded(forms: DataFrame, depth: int, agree: float) -> DataFrame:
    """``bucket``, ``form``, ``docs``: forms are listed by leaf and by each band of their tokens.

    Forms that agree in the share ``agree`` differ in ``d`` tokens at most, so of ``d + 1``
    bands behind the leading tokens one is alike in both.
    """
    n, rest = F.size("tokens"), F.size("tokens") - F.lit(depth)
    bands = n - F.ceil(n * F.lit(agree) - 1e-9).cast("int") + 1
    edge = lambda b: F.floor(b * rest / bands).cast("int")
    bucket = F.transform(
        F.sequence(F.lit(0), bands - 1),
        lambda b: F.xxhash64("leaf", b, F.slice("tokens", edge(b) + depth + 1, edge(b + 1) - edge(b))),
    )
    return forms.filter(rest > 0).select("form", "docs", "n", F.explode(bucket).alias("bucket"))


def _undecided(rows: DataFrame, min_docs: int) -> DataFrame:
    """The rows of buckets where several forms together may recur and one alone does not."""
    open_ = (
        rows.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("_forms"), F.sum("docs").alias("_sum"), F.min("docs").alias("_least"), F.max("n").alias("n"))
        .filter((F.col("_forms") > 1) & _enough(F.col("_sum"), min_docs) & ~_enough(F.col("_least"), min_docs))
    )
    return rows.join(open_.select("bucket"), "bucket", "left_semi")


def _with_seeds(rows: DataFrame, seeds: int) -> DataFrame:
    """``bucket``, ``form`` and ``seed``: all forms of a bucket with up to ``seeds`` of its commonest."""
    chosen = (
        rows.groupBy("bucket", F.pmod(F.xxhash64("form"), F.lit(seeds)))
        .agg(F.max(F.struct("docs", "form"))["form"].alias("seed"))
        .select("bucket", "seed")
    )
    return rows.select("bucket", "form").join(chosen, "bucket")


def _agreeing(pairs: DataFrame, forms: DataFrame, agree: float) -> DataFrame:
    """Pairs of ``form`` and ``seed`` that agree in the share ``agree`` of all their tokens."""
    left = forms.select("form", F.col("tokens").alias("_left"))
    right = forms.select(F.col("form").alias("seed"), F.col("tokens").alias("_right"))
    same = F.size(F.filter(F.zip_with("_left", "_right", lambda a, b: a == b), lambda x: x))
    return (
        pairs.select("form", "seed")
        .distinct()
        .join(left, "form")
        .join(right, "seed")
        .filter((F.size("_left") == F.size("_right")) & (same >= F.size("_left") * F.lit(agree) - 1e-9))
        .select("form", "seed")
    )


def _groups(forms: DataFrame, depth: int, min_docs: int, agree: float) -> DataFrame:
    """``form`` and the ``seed`` of a template that it belongs to.

    What agrees with no seed of its bucket goes on to the next round, with four times the
    seeds, until no bucket is left in which forms may recur together.
    """
    open_ = at_rest(_undecided(_banded(forms, depth, agree), min_docs), "undecided")
    found, seeds = forms.select("form", F.col("form").alias("seed")).filter("false"), SEEDS
    while not open_.isEmpty():
        pairs = at_rest(_with_seeds(open_, seeds), "seeds")
        links = at_rest(_agreeing(pairs, forms, agree), "groups")
        found = found.unionByName(links)
        settled = pairs.join(links, ["form", "seed"], "left_semi").select("bucket", "form").distinct()
        open_ = at_rest(_undecided(open_.join(settled, ["bucket", "form"], "left_anti"), min_docs), "undecided")
        seeds *= 4
    return found


def templates(
    docs: DataFrame, depth: int = DEPTH, min_docs: int = MIN_DOCS, fixed_share: float = FIXED_SHARE, agree: float = AGREE
) -> DataFrame:
    """``doc_id`` and ``line_key`` of the lines whose template recurs, with ``form``."""
    lines = parsed_lines(docs, depth)
    documents = lines.select("leaf", "n", "doc_id").distinct().groupBy("leaf", "n").agg(F.count(F.lit(1)).alias("docs"))
    often = rest(documents.filter(_enough(F.col("docs"), min_docs)).select("leaf"), "leaves")
    general = F.col("general")
    shown = F.when(F.col("fixed"), general).otherwise(F.col("spaced"))
    held = at_rest(
        _likely(lines, often)
        .select("doc_id", _hash(F.col("line")).alias("line_key"), "leaf", "n", _spaced(F.col("line")).alias("spaced"))
        .withColumn("general", _generalised(F.col("spaced")))
        .withColumn("fixed", F.col("n") - _variables(general) >= F.col("n") * F.lit(fixed_share))
        .withColumn("shown", shown)
        .select(
            "doc_id",
            "line_key",
            "leaf",
            "n",
            "fixed",
            "shown",
            _hash(F.concat(F.col("fixed").cast("string"), F.lit(" "), F.col("shown"))).alias("form"),
        ),
        "likely-lines",
    )
    forms = at_rest(
        held.select("form", "leaf", "n", "fixed", "shown", "doc_id")
        .distinct()
        .groupBy("form", "leaf", "n", "fixed", "shown")
        .agg(F.count(F.lit(1)).alias("docs"))
        .withColumn("tokens", F.split("shown", " ", -1))
        .drop("shown"),
        "forms",
    )
    groups = _groups(forms.filter("fixed"), depth, min_docs, agree)
    known = forms.select("form", "n", "docs")
    alone = known.filter(_enough(F.col("docs"), min_docs)).select("form")
    # A template with a recurring form recurs; documents need to be counted only where no form does.
    sized = at_rest(groups.join(known, "form"), "sized-groups")
    surely = sized.filter(_enough(F.col("docs"), min_docs)).select("seed")
    by_document = (
        held.select("form", "doc_id")
        .join(sized.filter(~_enough(F.col("docs"), min_docs)).select("form", "seed", "n"), "form")
        .select("seed", "n", "doc_id")
        .distinct()
        .groupBy("seed", "n")
        .agg(F.count(F.lit(1)).alias("docs"))
        .filter(_enough(F.col("docs"), min_docs))
        .select("seed")
    )
    seeds = at_rest(surely.unionByName(by_document).distinct(), "recurring-seeds")
    recurring = at_rest(groups.join(seeds, "seed", "left_semi").select("form").unionByName(alone).distinct(), "recurring")
    # Recurring forms are read from rest: a join with an aggregate could not split a hot form.
    return held.select("doc_id", "line_key", "form").join(recurring, "form", "left_semi")


def drop_recurring_lines(docs: DataFrame, **parameters) -> DataFrame:
    """The documents with recurring lines taken out of ``text``, and ``n_lines``, ``n_dropped``."""
    found = templates(docs, **parameters).select("doc_id", "line_key")
    marks = found.groupBy(F.col("doc_id").alias("__id")).agg(F.collect_set("line_key").alias("__dropped"))
    keyed = F.transform(
        _lines(F.col("text")), lambda line: F.struct(line.alias("line"), _hash(line).alias("key"))
    )
    # Null where nothing is dropped: such a text stays as it is and is not cut into lines.
    kept = F.when(
        F.col("__dropped").isNotNull(),
        F.transform(F.filter(keyed, lambda x: ~F.array_contains("__dropped", x["key"])), lambda x: x["line"]),
    )
    ends = F.octet_length("text") - F.octet_length(F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    n_lines = F.when(F.col("text").isNull(), F.lit(0)).otherwise(ends + 1)
    out = docs.join(marks, F.col("doc_id").eqNullSafe(F.col("__id")), "left").withColumn("__kept", kept)
    return (
        out.withColumn("n_lines", n_lines)
        .withColumn("n_dropped", F.when(F.col("__kept").isNull(), F.lit(0)).otherwise(F.col("n_lines") - F.size("__kept")))
        .withColumn("text", F.when(F.col("__kept").isNull(), F.col("text")).otherwise(F.array_join("__kept", "\n")))
        .drop("__id", "__dropped", "__kept")
    )


def line_report(docs: DataFrame) -> DataFrame:
    """What the query returns: counts and the SHA-256 of what is left of each text."""
    left = drop_recurring_lines(docs.select("doc_id", "text"))
    return left.select(
        "doc_id",
        F.col("n_lines").cast("long").alias("n_lines"),
        F.col("n_dropped").cast("long").alias("n_dropped"),
        F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("kept_chars"),
        F.sha2(F.col("text"), 256).alias("kept_sha256"),
    )
