"""Benchmark decontamination with a distributed positional inverted index.

Words of the benchmark are counted over all documents. Every benchmark window (``window``
consecutive words of an item; a shorter item is one window) is looked up from its rarest word: the
index stores (document, position) postings of these anchor words, each posting is adjusted by the
word's place in the item, and what remains is one candidate per (document, item, shift), however
long the shared passage is. Candidates are compared with the item along their shift, which gives
exact phrases; ``proximity_matches`` instead asks for the rarest words of an item within a span.
DataFrame functions only. The index is restricted to anchors, so the hot words of the corpus are
counted (partial sums) but never posted.

Defined results: null or word-free texts have no words and no hits; null or word-free items have
no windows; rows with equal ids are compared one by one and get their own result; rows without a
doc_id too; items that share an item_id count once; a null item_id is left out of the list of ids
but its windows hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from llm.common import lower_ascii, saved, table

WINDOW = 10
#: What stands between words; A-Z are words' letters here as they are lower-cased there.
BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def split_words(text: Column) -> Column:
    """Words in the order of the text. An empty one may stand first or last, so places are only shifted.

    They are as written; ``loose`` is what they are looked up by, which is much faster than the exact
    mapping that ``exact_words`` has. Where the two differ the exact one decides.
    """
    return F.split(F.coalesce(text, F.lit("")), BREAKS)


def loose(word: Column) -> Column:
    """The same for words that are exactly equal; of single words, as the lower case of a sigma depends on its neighbours."""
    return F.lower(word)


def exact_words(text: Column) -> Column:
    return F.split(lower_ascii(F.coalesce(text, F.lit(""))), BREAKS)


def _n_words(words: Column) -> Column:
    empty = F.when(F.element_at(words, 1) == "", 1).otherwise(0) + F.when(
        (F.size(words) > 1) & (F.element_at(words, -1) == ""), 1).otherwise(0)
    return (F.size(words) - empty).cast("long")


def _items(benchmark: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """One row per distinct item: item_id, key, words (exact), loose (as looked up), n, span."""
    rows = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("item_id"),
                            F.filter(exact_words(F.col(f"`{text}`")), lambda w: w != "").alias("words")
                            ).where(F.size("words") > 0).distinct()
    return rows.select("item_id", F.xxhash64("words", "item_id").alias("key"), "words",
                       F.transform("words", loose).alias("loose"), F.size("words").alias("n"),
                       F.least(F.size("words"), F.lit(window)).alias("span"))


def _postings(docs: DataFrame, doc_id: str, text: str, terms: DataFrame) -> DataFrame:
    """(doc_id, pos, term) of the given terms; terms has one row per term, so no posting repeats."""
    words = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.posexplode(split_words(F.col(f"`{text}`"))).alias("pos", "word"))
    return words.select("doc_id", "pos", loose(F.col("word")).alias("term")).join(terms, "term", "left_semi")


def term_counts(docs: DataFrame, text: str, terms: DataFrame) -> DataFrame:
    """Occurrences in all documents of each of the given terms, 0 for those that do not occur."""
    found = (docs.select(F.explode(split_words(F.col(f"`{text}`"))).alias("word")).select(loose(F.col("word")).alias("term"))
             .groupBy("term").agg(F.count(F.lit(1)).alias("n")))
    return terms.join(found, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))


def _anchors(items: DataFrame, counts: DataFrame) -> DataFrame:
    """(key, q, term): places in the items that are the rarest of some window."""
    places = items.select("key", "n", "span", F.posexplode("loose").alias("q", "term")).join(counts.withColumnRenamed("n", "df"), "term")
    # a window's rarest place, ties to the first, so that neighbouring windows share theirs
    windows = places.select("key", "q", "term", "df", F.explode(F.expr(
        "sequence(greatest(0, q - span + 1), least(q, n - span))")).alias("w"))
    best = windows.groupBy("key", "w").agg(F.min(F.struct("df", "q", "term")).alias("best"))
    return best.select("key", "best.q", "best.term").distinct()


def _candidates(docs: DataFrame, doc_id: str, text: str, anchors: DataFrame) -> DataFrame:
    """(doc_id, key, shift): alignments of an item with a document on which an anchor stands."""
    postings = _postings(docs, doc_id, text, anchors.select("term").distinct())
    return (postings.join(anchors, "term").select("doc_id", "key", (F.col("pos") - F.col("q")).alias("shift"))
            .distinct())


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, doc_id: str = "doc_id",
                  text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items_sha256, contaminated, item_ids, hits.

    hits lists the exact matches as (item_id, start, length) in words of the document. Columns of
    docs with these names are replaced.
    """
    items = saved(_items(benchmark, item_id, item_text, window), "op4-items")
    terms = items.select(F.explode("loose").alias("term")).distinct()
    counts = saved(term_counts(docs, text, terms), "op4-counts")
    anchors = saved(_anchors(items, counts), "op4-anchors")
    found = _candidates(docs, doc_id, text, anchors).join(items, "key")
    per_doc = (found.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "words", "n", "span", "shift")).alias("cands"))
               .withColumnRenamed("doc_id", "__id"))
    added = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "item_ids", "hits")
    plain = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added])
    rows = plain.join(per_doc, F.col(f"`{doc_id}`").eqNullSafe(F.col("__id")), "left").drop("__id")
    rows = rows.withColumn("__w", F.when(F.col("cands").isNull(), split_words(F.col(f"`{text}`")))
                           .otherwise(exact_words(F.col(f"`{text}`"))))
    hits = F.expr("""
        array_distinct(flatten(transform(cands, c -> transform(
            filter(sequence(0, c.n - c.span), i -> i + c.shift >= 0
                   and slice(__w, i + c.shift + 1, c.span) = slice(c.words, i + 1, c.span)),
            i -> struct(c.item_id as item_id, i + c.shift as start, c.span as length)))))""")
    rows = rows.withColumn("__h", F.coalesce(hits, F.expr("cast(array() as array<struct<item_id:string,start:int,length:int>>)")))
    # out of a generator, which filters do not cross: one on the result would else be pushed down with the
    # splitting of the text written into the comparison of every window
    rows = rows.select(*[F.col(f"`{c}`") for c in plain.columns],
                       F.inline(F.array(F.struct(_n_words(F.col("__w")).alias("n_words"), F.col("__h").alias("hits")))))
    covered = F.expr("cast(size(array_distinct(flatten(transform(hits, h -> sequence(h.start, h.start + h.length - 1))))) as bigint)")
    ids = F.array_sort(F.array_distinct(F.filter(F.transform("hits", lambda h: h["item_id"]), lambda i: i.isNotNull())))
    rows = rows.withColumns({"n_hit": covered, "item_ids": ids})
    return rows.withColumns({"n_items": F.size("item_ids").cast("long"),
                             "items_sha256": F.sha2(F.concat_ws(",", "item_ids"), 256),
                             "contaminated": F.col("n_hit") > 0})


def proximity_matches(docs: DataFrame, benchmark: DataFrame, terms: int = 3, within: int = 20, doc_id: str = "doc_id",
                      text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, start, end): documents holding the item's rarest ``terms`` words within a span.

    One row per place of the rarest word around which, at most ``within`` words away, each of the
    others stands; start and end are the outermost places used.
    """
    items = saved(_items(benchmark, item_id, item_text, 1), "op4-near-items")
    counts = saved(term_counts(docs, text, items.select(F.explode("loose").alias("term")).distinct()), "op4-near-counts")
    ranked = (items.select("item_id", "key", F.explode(F.array_distinct("loose")).alias("term")).join(counts, "term")
              .groupBy("item_id", "key").agg(F.sort_array(F.collect_list(F.struct("n", "term"))).alias("all"))
              .select("item_id", "key", F.slice("all", 1, terms).alias("all"))
              .select("item_id", "key", F.size("all").alias("k"), F.posexplode("all").alias("rank", "e"))
              .select("item_id", "key", "k", "rank", F.col("e.term").alias("term")))
    ranked = saved(ranked, "op4-near-terms")
    posts = saved(_postings(docs, doc_id, text, ranked.select("term").distinct()), "op4-near-postings")
    lists = posts.join(ranked, "term")
    first = lists.where("rank = 0").select("doc_id", "key", "item_id", "k", F.col("pos").alias("at"))
    rest = lists.select("doc_id", "key", "rank", "pos", F.explode(F.array(
        F.floor(F.col("pos") / within) - 1, F.floor(F.col("pos") / within), F.floor(F.col("pos") / within) + 1)).alias("cell"))
    near = (first.withColumn("cell", F.floor(F.col("at") / within)).join(rest, ["doc_id", "key", "cell"])
            .where(F.abs(F.col("pos") - F.col("at")) <= within)
            .groupBy("doc_id", "key", "item_id", "k", "at", "rank")
            .agg(F.min(F.struct(F.abs(F.col("pos") - F.col("at")).alias("d"), "pos")).alias("best")))
    return (near.groupBy("doc_id", "key", "item_id", "k", "at")
            .agg(F.count(F.lit(1)).alias("have"), F.min("best.pos").alias("start"), F.max("best.pos").alias("end"))
            .where("have = k").select("doc_id", "item_id", "start", "end"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return contamination(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE = f"""
with d as (select doc_id, {_WORDS} as w from documents),
b as (select cast(item_id as varchar) as item_id, {_WORDS} as w from benchmark),
bw as (select distinct item_id, least(len(w), {WINDOW}) as span, array_to_string(w[i:i + least(len(w), {WINDOW}) - 1], ' ') as win
       from (select *, unnest(generate_series(1, len(w) - least(len(w), {WINDOW}) + 1)) as i from b where len(w) > 0)),
spans as (select distinct span from bw),
dw as (select doc_id, span, i, array_to_string(w[i:i + span - 1], ' ') as win
       from (select doc_id, w, span, unnest(generate_series(1, len(w) - span + 1)) as i from d, spans where len(w) >= span)),
hit as (select dw.doc_id, bw.item_id, dw.i, dw.span from dw join bw on dw.win = bw.win and dw.span = bw.span),
pos as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(generate_series(i, i + span - 1)) as p from hit) group by 1),
ids as (select doc_id, count(*) as n_items, sha256(string_agg(item_id, ',' order by item_id)) as s from (select distinct doc_id, item_id from hit) group by 1)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       coalesce(s, sha256('')) as items_sha256, n_hit is not null as contaminated
from d left join pos using (doc_id) left join ids using (doc_id)
"""
