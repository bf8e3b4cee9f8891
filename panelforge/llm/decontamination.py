"""Benchmark decontamination by a positional inverted index, in Spark's built-in functions alone.

Test items are cut into windows of consecutive words. Each window is looked up by its rarest terms:
term frequencies are counted over the whole corpus, postings (term, document, position) are stored for
just the terms that some window needs, and the lists of a window's two rarest terms are intersected
after subtracting the terms' offsets, so that they meet on the position where the window would start.
What meets is compared word by word with the document (exact phrase); ``proximity`` returns where the
rarest terms of an item lie close together in any order.

A common passage or term is split by document; no list of a term or an item is gathered anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelforge.llm.common import ascii_lower
from panelforge.session import stage

WINDOW = 13
#: Words are runs of ASCII letters and digits and of anything beyond ASCII.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased (A-Z) words of a text; none for NULL."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item_id, v, start, terms``: the windows of each item; a shorter item is one window.

    ``v`` tells apart the texts of items that share an id; repeated rows count once. Items without
    words or id have no window.
    """
    w = items(benchmark)
    last = F.greatest(F.size("w") - window, F.lit(0))
    return (w.select("item_id", "v", "w", F.explode(F.sequence(F.lit(0), last)).alias("start"))
            .select("item_id", "v", "start", F.slice("w", F.col("start") + 1, window).alias("terms")))


def items(benchmark: DataFrame) -> DataFrame:
    """``item_id, v, w``: the words of each distinct item."""
    w = (benchmark.where("item_id is not null").select("item_id", words(F.col("text")).alias("w"))
         .where(F.size("w") > 0).distinct())
    return w.withColumn("v", F.row_number().over(Window.partitionBy("item_id").orderBy("w")))


def term_counts(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``term, n``: how often each term of the vocabulary occurs in the whole corpus, if at all."""
    said = docs.select(F.explode(words(F.col("text"))).alias("term"))
    return said.join(vocabulary, "term").groupBy("term").agg(F.count("*").alias("n"))


def anchors(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """``item_id, v, start, o1, t1, o2, t2``: the two rarest terms of each window and their offsets.

    Windows that hold a term the corpus lacks cannot occur and are left out. Ties go to the lower
    offset. A window of one word has itself twice.
    """
    at = (windows.select("item_id", "v", "start", F.posexplode("terms").alias("o", "term"))
          .join(counts, "term", "left"))
    by = ["item_id", "v", "start"]
    lists = at.groupBy(by).agg(F.count("*").alias("size"), F.count("n").alias("known"),
                               F.array_sort(F.collect_list(F.struct("n", "o", "term"))).alias("t"))
    one, two = F.col("t")[0], F.col("t")[F.least(F.size("t"), F.lit(2)) - 1]
    return lists.where("size = known").select(
        *by, one["o"].alias("o1"), one["term"].alias("t1"), two["o"].alias("o2"), two["term"].alias("t2"))


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``term, doc_id, pos`` of the given terms; positions count words from 0."""
    said = docs.select("doc_id", F.posexplode(words(F.col("text"))).alias("pos", "term"))
    return said.join(terms, "term").select("term", "doc_id", "pos")


def _index(docs: DataFrame, benchmark: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """Anchors and postings. Small tables are staged, so that Spark knows their size when it plans a join."""
    windows = item_windows(benchmark, window)
    vocabulary = stage(windows.select(F.explode("terms").alias("term")).distinct(), "vocabulary")
    counts = stage(term_counts(docs, vocabulary), "term-counts")
    chosen = stage(anchors(windows, counts), "anchors")
    needed = stage(chosen.select(F.col("t1").alias("term")).union(chosen.select("t2")).distinct(), "needed")
    return chosen, stage(postings(docs, needed), "postings")


def candidates(chosen: DataFrame, index: DataFrame) -> DataFrame:
    """``doc_id, item_id, v, shift, low, high``: both rarest terms of the item's windows low..high stand
    in the document as they do in the item, ``shift`` words further on."""
    # windows side by side mostly share their anchors: the lists meet once for all of them
    pairs = chosen.groupBy("item_id", "v", (F.col("start") + F.col("o1")).alias("p1"), "t1",
                           (F.col("start") + F.col("o2")).alias("p2"), "t2").agg(
        F.min("start").alias("low"), F.max("start").alias("high"))
    pairs = stage(pairs, "pairs")
    one = (index.withColumnRenamed("term", "t1").join(pairs, "t1")
           .select("doc_id", "item_id", "v", "p2", "low", "high", (F.col("pos") - F.col("p1")).alias("shift")))
    two = (index.withColumnRenamed("term", "t2").join(pairs.select("t2", "p2", "item_id", "v").distinct(), "t2")
           .select("doc_id", "item_id", "v", "p2", (F.col("pos") - F.col("p2")).alias("shift")))
    one, two = one.alias("one"), two.alias("two")
    same = F.col("one.doc_id").eqNullSafe(F.col("two.doc_id"))
    for c in ("item_id", "v", "p2", "shift"):
        same = same & (F.col(f"one.{c}") == F.col(f"two.{c}"))
    return one.join(two, same, "left_semi").select("doc_id", "item_id", "v", "shift", "low", "high").distinct()


def _hits(w: Column, found: Column, window: int) -> Column:
    """Of the candidates of a document, those windows that stand in ``w`` word by word."""
    def of_item(c):
        n = F.least(F.size(c["w"]), F.lit(window))

        def of_shift(at):
            starts = F.filter(F.sequence(at["low"], at["high"]), lambda s: (
                (s + at["shift"] >= 0)
                & (F.slice(c["w"], s + 1, n) == F.slice(w, F.greatest(s + at["shift"], F.lit(0)) + 1, n))))
            return F.transform(starts, lambda s: F.struct(
                c["item_id"].alias("item_id"), (s + at["shift"]).alias("from_pos"), n.alias("n")))

        return F.flatten(F.transform(c["at"], of_shift))

    return F.flatten(F.transform(found, of_item))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: float = 0.05) -> DataFrame:
    """``docs`` with a struct ``hits``: n_words, n_hit, items, matches, contaminated; a row for each row.

    A document word inside any occurrence of a window is hit; a document is contaminated if at least
    ``share`` of its words are. ``matches`` are (item_id, from_pos, n). NULL and empty texts have no
    words and no hits. Rows that share a doc_id are each compared by their own text. A column named
    ``hits`` is replaced, others pass through. An empty benchmark hits nothing.
    """
    chosen, index = _index(docs, benchmark, window)
    by_item = (candidates(chosen, index).groupBy("doc_id", "item_id", "v")
               .agg(F.collect_list(F.struct("shift", "low", "high")).alias("at")))
    per_doc = (by_item.join(stage(items(benchmark), "items"), ["item_id", "v"]).groupBy("doc_id")
               .agg(F.collect_list(F.struct("item_id", "w", "at")).alias("__found"))
               .withColumnRenamed("doc_id", "__doc"))
    docs = docs.drop("hits")
    # what was found grows with the corpus, so it is merged, never broadcast, at any size
    joined = docs.join(stage(per_doc, "found").hint("merge"), F.col("doc_id").eqNullSafe(F.col("__doc")), "left").drop("__doc")
    kind = f"array<struct<item_id:{benchmark.schema['item_id'].dataType.simpleString()},from_pos:int,n:int>>"
    found = F.array_distinct(_hits(F.col("__w"), F.col("__found"), window))
    matches = F.when(F.col("__found").isNull(), F.array()).otherwise(found).cast(kind)
    hit = F.size(F.array_distinct(F.flatten(F.transform(
        "__m", lambda m: F.sequence(m["from_pos"], m["from_pos"] + m["n"] - 1)))))
    out = (joined.withColumn("__w", words(F.col("text"))).withColumn("__m", matches)
           .withColumn("__n", F.size("__w").cast("long")).withColumn("__hit", hit.cast("long")))
    return out.withColumn("hits", F.struct(
        F.col("__n").alias("n_words"), F.col("__hit").alias("n_hit"),
        F.array_distinct(F.transform("__m", lambda m: m["item_id"])).alias("items"), F.col("__m").alias("matches"),
        F.when(F.col("__hit") > 0, F.col("__hit") / F.col("__n") >= share).otherwise(False).alias("contaminated"))
    ).drop("__found", "__w", "__m", "__n", "__hit")


def proximity(docs: DataFrame, benchmark: DataFrame, reach: int = 30, window: int = WINDOW) -> DataFrame:
    """``doc_id, item_id, near``: windows whose two rarest terms stand within ``reach`` words, any order.

    ``near`` counts the distinct windows of the item. Positions are cut into cells of ``reach`` words, so
    that only postings of one or two cells of one document meet. For rewritten or reordered passages;
    exact phrases are among them.
    """
    chosen, index = _index(docs, benchmark, window)
    index = index.where("doc_id is not null")
    cell = F.floor(F.col("pos") / reach)
    need = chosen.select("item_id", "start", "t1", "t2").distinct()
    left = index.select(F.col("term").alias("t1"), "doc_id", F.col("pos").alias("p"), cell.alias("cell"))
    right = index.select(F.col("term").alias("t2"), "doc_id", F.col("pos").alias("q"),
                         F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"))
    met = (left.join(need.select("t1", "t2").distinct(), "t1").join(right, ["t2", "doc_id", "cell"])
           .where(F.abs(F.col("p") - F.col("q")) <= reach).select("t1", "t2", "doc_id").distinct())
    return met.join(need, ["t1", "t2"]).groupBy("doc_id", "item_id").agg(F.count_distinct("start").alias("near"))


def digest(hits: Column) -> list[Column]:
    """The columns of the query from the struct that ``decontaminate`` adds."""
    ids = F.array_sort(F.transform(hits["items"], lambda i: i.cast("string")))
    return [hits["n_words"].alias("n_words"), hits["n_hit"].alias("n_hit"),
            F.size(hits["items"]).cast("long").alias("n_items"),
            F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
            ((hits["n_hit"] > 0) & (20 * hits["n_hit"] >= hits["n_words"])).alias("contaminated")]


ORACLE = r"""
WITH w AS (SELECT doc_id, row_number() OVER () AS rn,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, list_slice(w, s + 1, s + 13) AS g
        FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 13, 0) + 1)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (SELECT rn, n, s, list_slice(w, s + 1, s + n) AS g
          FROM (SELECT rn, w, n, unnest(range(len(w) - n + 1)) AS s FROM w, sizes WHERE len(w) >= n)),
hit AS (SELECT rn, item_id, s, grams.n FROM grams JOIN win ON grams.n = win.n AND grams.g = win.g),
pos AS (SELECT rn, count(DISTINCT p) AS n_hit FROM (SELECT rn, unnest(range(s, s + n)) AS p FROM hit) GROUP BY rn),
ids AS (SELECT rn, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS s
        FROM (SELECT DISTINCT rn, item_id::VARCHAR AS i FROM hit) GROUP BY rn)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM w LEFT JOIN pos USING (rn) LEFT JOIN ids USING (rn)
"""
