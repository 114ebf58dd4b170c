r"""Line dedup by a tree of line templates, in DataFrame functions only.

Words with digits are variable fields. A line goes down a tree of fixed depth: first by its number
of words, then by its first words. In a leaf that holds several templates, the words that most of
them share at a place form the leaf's own template, the other places are variable; templates close
enough to it are taken for the same. A template found in at least ``min_docs`` documents recurs: it
is kept where it comes first (smallest doc_id, then line) and dropped everywhere else. A line of more
than ``passage_words`` words also recurs once its exact words, digits included, stand in two documents.

Texts are read twice: once to turn lines into numbers, and once for the lines of the templates that have to be
compared word by word, one line for each. What is dropped is taken out in a third look.

Edge cases: lines without a word are never templates and stay; a null or empty text has nothing to
drop; a document that loses all its lines with words goes with them; rows equal in id and text are
one document; null ids come first and count as one; an empty table stays empty; columns other than
doc_id and text are passed through whatever their names. No group is collected: leaves and templates
are only counted, so a line or leaf may hold any share of all lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexstats.sources.staging import stage

#: documents a template must be found in
MIN_DOCS = 3
#: words beyond which a line of the same exact words is a repeated passage, and documents it must be in
PASSAGE_WORDS, PASSAGE_DOCS = 50, 2
#: leading words that the tree branches by
DEPTH = 3
#: share of places at which a template must agree with that of its leaf
CLOSE = 0.8
SPACES = r"[\x20\x09-\x0D]+"
VARIABLE = r"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*"


#: what most lines do not have; one look for all of it costs far less than replacing
ODD = r"[0-9\x09-\x0D]|\x20\x20"


def template(line: Column) -> Column:
    """A line's words, those with digits replaced by a mark, with one space between."""
    marked = F.regexp_replace(F.regexp_replace(line, VARIABLE, "<*>"), SPACES, " ")
    return F.trim(F.when(line.rlike(ODD), marked).otherwise(line))


def exact(line: Column) -> Column:
    """A line's words with one space between."""
    return F.trim(F.regexp_replace(line, SPACES, " "))


def _lines(docs: DataFrame) -> DataFrame:
    """(doc, version, line, content, template, words, leaf) of the lines with words."""
    lines = docs.select(
        F.col("doc_id").alias("doc"),
        F.xxhash64("text").alias("version"),
        F.posexplode(F.split("text", "\n")).alias("line", "content"),
    ).select("doc", "version", "line", "content", template(F.col("content")).alias("template"))
    # sizes in bytes are known without a look at the text
    words = F.octet_length("template") - F.octet_length(F.replace("template", F.lit(" "), F.lit(""))) + 1
    lead = F.substring_index("template", " ", DEPTH)
    return (
        lines.filter(F.col("template") != "")
        .withColumn("words", words)
        .withColumn("leaf", F.xxhash64(F.col("words"), lead))
    )


def _key() -> list[Column]:
    """128 bits that stand for a template."""
    return [F.xxhash64("template").alias("k1"), F.xxhash64(F.lit(1), F.col("template")).alias("k2")]


def _generalised(docs: DataFrame, parsed: DataFrame) -> DataFrame:
    """(k1, k2, leaf) of the templates that are close to the template of their leaf."""
    busy = (
        parsed.filter(F.col("words") > DEPTH)
        .groupBy("leaf")
        .agg(F.min("k1").alias("low"), F.max("k1").alias("high"), F.count(F.lit(1)).alias("n"))
        .filter((F.col("low") != F.col("high")) & (F.col("n") >= MIN_DOCS))
        .select("leaf")
    )
    # one line for each template, found among the numbers; only their texts are fetched
    place = F.xxhash64("doc", "version", "line")
    one = (
        parsed.filter(F.col("words") > DEPTH)
        .join(busy, "leaf", "left_semi")
        .withColumn("place", place)
        .groupBy("leaf", "k1", "k2")
        .agg(*[F.min_by(c, "place").alias(c) for c in ("doc", "version", "line")])
    )
    wanted = one.groupBy("doc", "version").agg(F.collect_list(F.struct("leaf", "k1", "k2", "line")).alias("wanted"))  # lines of one text
    texts = docs.select(F.col("doc_id").alias("_doc"), F.xxhash64("text").alias("_version"), "text")
    found = texts.join(wanted, texts["_doc"].eqNullSafe(wanted["doc"]) & (texts["_version"] == wanted["version"]))
    lines = F.split("text", "\n")
    fetched = found.select(lines.alias("lines"), "wanted").select(
        F.explode(
            F.transform("wanted", lambda w: F.struct(w["leaf"], w["k1"], w["k2"], F.element_at("lines", w["line"] + 1).alias("content")))
        ).alias("w")
    ).select("w.*")
    # repeated rows bring their lines again
    templates = stage(
        fetched.groupBy("leaf", "k1", "k2").agg(F.first("content").alias("content")).select(
            "leaf", "k1", "k2", template(F.col("content")).alias("template")
        )
    )
    places = templates.select(
        "leaf", "k1", "k2", F.posexplode(F.split("template", " ")).alias("place", "word")
    )
    counts = places.groupBy("leaf", "place", "word").agg(F.count(F.lit(1)).alias("n"))
    shared = (
        counts.groupBy("leaf", "place")
        .agg(F.sum("n").alias("all"), F.min(F.struct(-F.col("n"), "word")).alias("top"))
        .filter(-2 * F.col("top.col1") > F.col("all"))
        .select("leaf", "place", F.col("top.word").alias("word"))
    )
    agreed = places.join(shared, ["leaf", "place", "word"], "left_semi")
    near = agreed.groupBy("leaf", "k1", "k2").agg(F.count(F.lit(1)).alias("same"))
    lengths = templates.select("leaf", "k1", "k2", F.size(F.split("template", " ")).alias("places"))
    close = F.col("same") >= CLOSE * F.col("places")
    return near.join(lengths, ["leaf", "k1", "k2"]).filter(close).select("k1", "k2", "leaf")


def _passage_key(passage_words: int) -> list[Column]:
    """128 bits that stand for the exact words of a long line; null for other lines.

    Without digits and odd spaces the exact words are the template, whose key is known.
    """
    long, odd, words = F.col("words") > passage_words, F.col("content").rlike(ODD), exact(F.col("content"))
    own = (F.xxhash64(words), F.xxhash64(F.lit(1), words))
    known = (F.xxhash64("template"), F.xxhash64(F.lit(1), F.col("template")))
    return [F.when(long, F.when(odd, x).otherwise(k)).alias(name) for name, x, k in zip(("x2", "x3"), own, known, strict=True)]


def dropped_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, passage_words: int | None = None, copies_share: float | None = None
) -> DataFrame:
    """(doc, version, line) of every line that goes.

    With ``copies_share``, a document keeps all its lines if those that would go and come first in one and the
    same other document have at least that share of the words of either: it is a copy of that, to be
    judged as a whole.
    """
    passages = [] if passage_words is None else _passage_key(passage_words)
    parsed = stage(_lines(docs).select("doc", "version", "line", "words", "leaf", *_key(), *passages))
    general = stage(_generalised(docs, parsed))
    # the id of a line's template: its leaf when it is close to the leaf's template, else its own
    own = F.struct(F.col("k1").alias("a"), F.col("k2").alias("b"))
    by_leaf = F.struct(F.col("near_leaf").alias("a"), F.lit(None).cast("long").alias("b"))
    named = parsed.join(general.withColumnRenamed("leaf", "near_leaf"), ["k1", "k2"], "left").select(
        "doc", "version", "line", "words", F.when(F.col("near_leaf").isNotNull(), by_leaf).otherwise(own).alias("id")
    )
    named = named.select(
        "doc", "version", "line", "words", F.col("id.a").alias("a"), F.coalesce("id.b", F.lit(0)).alias("b"),
        F.lit(min_docs).alias("enough"),
    )
    if passages:
        # a passage is part of one template, so the first line of the template is first of its passage too
        long = parsed.filter(F.col("x2").isNotNull())
        named = named.unionByName(
            long.select("doc", "version", "line", "words", F.col("x2").alias("a"), F.col("x3").alias("b"), F.lit(PASSAGE_DOCS).alias("enough"))
        )
    # numbers of fixed width throughout, so that all this is aggregated by hash
    recurring = (
        named.withColumn("nth", F.coalesce("doc", F.lit(-(1 << 63))))
        .groupBy("a", "b", "enough", "nth")
        .agg(F.min("line").alias("line"), F.min_by("version", "line").alias("version"))
        .groupBy("a", "b", "enough")
        .agg(
            F.count(F.lit(1)).alias("docs"),
            F.min("nth").alias("nth"),
            F.min_by("line", "nth").alias("first_line"),
            F.min_by("version", "nth").alias("first_version"),
        )
        .filter(F.col("docs") >= F.col("enough"))
    )
    is_first = (
        (F.coalesce("doc", F.lit(-(1 << 63))) == F.col("nth"))
        & (F.col("version") == F.col("first_version"))
        & (F.col("line") == F.col("first_line"))
    )
    gone = named.join(recurring, ["a", "b", "enough"]).filter(~is_first)
    if copies_share is None:
        gone = gone.select("doc", "version", "line")
        return gone.distinct() if passages else gone
    gone = stage(gone.select("doc", "version", "line", "words", "nth", "first_version").distinct())
    sizes = parsed.groupBy(F.coalesce("doc", F.lit(-(1 << 63))).alias("id"), "version").agg(F.sum("words").alias("words"))
    own, first = sizes.toDF("id", "version", "own_words"), sizes.toDF("nth", "first_version", "first_words")
    copies = (
        gone.groupBy(F.coalesce("doc", F.lit(-(1 << 63))).alias("id"), "version", "nth", "first_version")
        .agg(F.sum("words").alias("common"))
        .join(own, ["id", "version"])
        .join(first, ["nth", "first_version"])
        .filter(F.col("common") >= F.greatest("own_words", "first_words") * copies_share)
        .select("id", "version")
        .distinct()
    )
    cut = gone.withColumn("id", F.coalesce("doc", F.lit(-(1 << 63)))).join(copies, ["id", "version"], "left_anti")
    return cut.select("doc", "version", "line").distinct()


def with_kept_text(
    docs: DataFrame, min_docs: int = MIN_DOCS, passage_words: int | None = None, copies_share: float | None = None
) -> DataFrame:
    """(_row, kept, n_lines, n_dropped, emptied): each document as a struct, and what is left of it."""
    gone = (
        dropped_lines(docs, min_docs, passage_words, copies_share)
        .groupBy("doc", "version")
        .agg(F.collect_list("line").alias("gone"))  # at most the lines of one text
    )
    rows = docs.select(
        F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_doc"), F.xxhash64("text").alias("_version")
    )
    joined = rows.join(
        gone, rows["_doc"].eqNullSafe(gone["doc"]) & (rows["_version"] == gone["version"]), "left"
    )
    lines = F.split("_row.text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    left = F.transform(kept, lambda i: F.element_at(lines, i + 1))
    return joined.select(
        "_row",
        F.when(F.col("gone").isNull(), F.col("_row.text")).otherwise(F.array_join(left, "\n")).alias("kept"),
        F.when(F.col("_row.text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
    ).withColumn("emptied", (F.col("n_dropped") > 0) & ~F.col("kept").rlike(r"[^\x20\x09-\x0D]"))


def dedup_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, passage_words: int | None = None, copies_share: float | None = None
) -> DataFrame:
    """``docs`` with recurring lines taken out of ``text``, without the documents nothing is left of.

    ``copies_share`` leaves copies of one document whole, for a later step that drops near copies: of a copy cut
    to scraps that step could no longer tell what it is.
    """
    kept = with_kept_text(docs, min_docs, passage_words, copies_share).filter(~F.col("emptied"))
    return kept.select(*[F.col("kept").alias("text") if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns])


def report(docs: DataFrame, min_docs: int = MIN_DOCS, passage_words: int | None = PASSAGE_WORDS) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, emptied, kept_sha256 (of the remaining text)."""
    return with_kept_text(docs, min_docs, passage_words).select(
        F.col("_row.doc_id").alias("doc_id"),
        "n_lines",
        "n_dropped",
        "emptied",
        F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"),
    )
