"""N-gram Jaccard self-join by vertical partitioning.

A document's set is its distinct word n-grams. Documents with equal sets are one class and are
joined once. The n-grams are put in one global order, rare before frequent (powers of two of the
number of classes that hold them), then by name; the order is cut into fragments, and every set with
it. Two sets that reach the threshold share one of the first n-grams of both (their prefixes), so
those of the prefixes that stand in several classes give the candidates, which sizes and places
thin out. For each candidate pair the overlaps of its fragments are counted separately and summed.

Links are wanted as components, so no group of copies is expanded into pairs: members of a posting
list meet its leader first, and after components of these links are found, only members of
different components of a list meet each other, where a stretch of common n-grams begins. Before overlaps
of a pair are counted, 512 parities of each set (how many of its n-grams fall on a number, odd or even)
bound how much the sets differ at least. N-grams are compared by 64-bit names.

Defined results: null text has no words, its set is empty and links with nothing; a text of fewer
than ``n`` words has one n-gram, all its words; a row without a doc_id has its n_shingles and no
component; rows that repeat a doc_id are one document with several sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from llm.common import connected, saved, table
from llm.exchange import ANSWER, QUESTION, Deal, answer_parts, answers, ask, chunk_of, deal
from llm.textnp import U, lower_ascii, ranges, slices, text_bytes, unpack_values, word_names, words

N, THRESHOLD = 4, 85  # words, percent
CLASSES = 16          # powers of two told apart by the global order
CUTS = 4              # fragments per power of two
MARKS = 512           # parities of a set
PIVOTS = (8, 64)  # members of a posting list that all its members meet first, chosen anew in each round


def shingles(column: pa.ChunkedArray | pa.Array, n: int, lower: bool = True) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct (row, name) of the n-grams of every row, sorted, and the number of rows."""
    raw, offsets = text_bytes(column)
    starts, ends, row = words(raw, offsets)
    names = word_names(lower_ascii(raw) if lower else raw, starts, ends)
    rows = len(offsets) - 1
    count = np.bincount(row, minlength=rows)
    first = np.cumsum(count) - count
    length = np.minimum(count, n)
    many = np.maximum(count - n + 1, (count > 0).astype(np.int64))
    doc = np.repeat(np.arange(rows), many)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many) + first[doc]
    grams = ranges(names, at, at + length[doc])
    order = np.lexsort((grams, doc))
    doc, grams = doc[order], grams[order]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (grams[1:] != grams[:-1])])[:len(doc)]
    return doc[new], grams[new], rows


def set_names(doc: np.ndarray, grams: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Size of every row's set, and a name that only equal sets share (0 for the empty one)."""
    count = np.bincount(doc, minlength=rows)
    first = np.cumsum(count) - count
    name = ranges(grams, first, first + count)
    return count, np.where(count > 0, name | U(1), U(0)).view(np.int64)


def _sets(n: int):
    def f(batches):
        for b in slices(batches, "text"):
            count, name = set_names(*shingles(b.column("text"), n))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(count, pa.int64()), pa.array(name, pa.int64())],
                                             names=["doc_id", "n_shingles", "cls"])
    return f


def _of_classes(left: pa.Table, right: pa.Table, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class, its size, n-grams flattened) of the classes whose representative is in this chunk."""
    wanted = {(i, c) for r, i, c in zip(right["round"].to_pylist(), right["doc_id"].to_pylist(), right["cls"].to_pylist()) if r == 0}
    ids = left["doc_id"].to_pylist()
    mine = {i for i, _ in wanted}
    some = np.array([k for k, i in enumerate(ids) if i in mine], np.int64)
    if not len(some):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U)
    doc, grams, rows = shingles(left["text"].take(pa.array(some)), n)
    count, name = set_names(doc, grams, rows)
    keep = np.zeros(rows, bool)
    for k, c in enumerate(name.tolist()):
        if (ids[some[k]], c) in wanted:
            wanted.discard((ids[some[k]], c))
            keep[k] = True
    return name[keep], count[keep], grams[keep[doc]]


def _ask_counts(sizes: Deal, n: int):
    def f(left: pa.Table, right: pa.Table) -> pa.Table:
        _, _, grams = _of_classes(left, right, n)
        keys, often = np.unique(grams >> U(64 - sizes.bits), return_counts=True)
        chunk = (left if len(left) else right)["chunk"][0].as_py()
        return ask(chunk, 1, keys, often, sizes.bits, sizes.buckets)
    return f


def _counts(group: pa.Table) -> pa.Table:
    """log2 of the number of classes that hold each key, a byte each."""
    def combine(order, number, ends, vals):
        often = np.concatenate([unpack_values(v) for v in vals])
        total = np.bincount(number, often[order]) if len(number) else np.zeros(0)
        level = np.zeros(len(order), np.uint8)
        level[order] = np.minimum(np.log2(np.maximum(total, 1)).astype(np.uint8), CLASSES - 1)[number]
        return [x.tobytes() for x in np.split(level, ends[:-1])]
    return answers(group, combine)


SETS = "cls long, size long, frag int, start int, n_prefix int, prev long, grams array<long>, marks array<long>"


def parities(of: np.ndarray, grams: np.ndarray, rows: int) -> np.ndarray:
    """(rows, MARKS / 64) words of bits: whether an odd number of a row's n-grams falls on each place."""
    place = of * MARKS + (grams & U(MARKS - 1)).astype(np.int64)
    odd = (np.bincount(place, minlength=rows * MARKS) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(rows, MARKS), axis=1, bitorder="little").view(np.int64)


def _cut_sets(sizes: Deal, n: int, percent: int):
    """Every class's n-grams that stand in several classes, by fragment, in the global order."""
    def f(left: pa.Table, right: pa.Table) -> pa.Table:
        name, count, grams = _of_classes(left, right, n)
        of = np.repeat(np.arange(len(name)), count)
        marks = parities(of, grams, len(name))
        keys, place = np.unique(grams >> U(64 - sizes.bits), return_inverse=True)
        level = np.frombuffer(b"".join(answer_parts(right, 1)), np.uint8)[place] if len(keys) else np.zeros(0, np.uint8)
        order = np.lexsort((grams, level, of))
        of, grams, level = of[order], grams[order], level[order]
        first = np.cumsum(count) - count
        rank = np.arange(len(of)) - first[of]
        prefix = (count - (percent * count + 99) // 100 + 1)[of]
        some = np.flatnonzero(level > 0)  # what stands in one class only overlaps with nothing
        of, grams, rank, prefix, level = of[some], grams[some], rank[some], prefix[some], level[some]
        frag = level.astype(np.int64) * CUTS + (grams >> U(62)).astype(np.int64)
        new = np.concatenate([[True], (of[1:] != of[:-1]) | (frag[1:] != frag[:-1])])[:len(of)]
        at = np.flatnonzero(new)
        inside = np.add.reduceat((rank < prefix).astype(np.int64), at) if len(at) else np.zeros(0, np.int64)
        # the n-gram that stands before the fragment, if any
        first_of = new.copy()
        first_of[1:] = of[1:] != of[:-1]
        prev = pa.array(np.roll(grams, 1)[at].view(np.int64), pa.int64(), mask=first_of[at])
        lists = pa.ListArray.from_arrays(pa.array(np.append(at, len(of)).astype(np.int32)), pa.array(grams.view(np.int64)))
        # a class's marks stand in its first row
        marked = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(at) + 1) * marks.shape[1], marks.shape[1], np.int32)),
                                          pa.array(marks[of[at]].ravel()), mask=pa.array(~first_of[at]))
        return pa.table({"cls": pa.array(name[of[at]], pa.int64()), "size": pa.array(count[of[at]], pa.int64()),
                         "frag": pa.array(frag[at], pa.int32()), "start": pa.array(rank[at], pa.int32()),
                         "n_prefix": pa.array(inside, pa.int32()), "prev": prev, "grams": lists, "marks": marked})
    return f


def _needed(a: str, b: str, percent: int):
    """Least overlap at which 100 * overlap >= percent * union."""
    return F.ceil(F.lit(percent) * (F.col(a) + F.col(b)) / (100 + percent))


def _passes(pairs: DataFrame, percent: int) -> DataFrame:
    """Candidates whose sizes and places in the order let them reach the threshold."""
    fits = 100 * F.least("size", "o_size") >= percent * F.greatest("size", "o_size")
    rest = F.least(F.col("size") - F.col("pos"), F.col("o_size") - F.col("o_pos"))
    return pairs.where(fits & (rest >= _needed("size", "o_size", percent)))


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the distinct pairs (cls, other, size, o_size) those that reach the threshold: overlaps by fragment, summed.

    Every n-gram that only one of two sets holds changes one parity, so sets differ by at least as many
    n-grams as parities; pairs that differ by too many are dropped first.
    """
    marks = sets.where("marks is not null").select("cls", "marks")
    differ = sum((F.bit_count(F.col("marks")[i].bitwiseXOR(F.col("o_marks")[i])) for i in range(MARKS // 64)), F.lit(0))
    pairs = saved(pairs.join(marks, "cls").join(marks.select(F.col("cls").alias("other"), F.col("marks").alias("o_marks")), "other")
                  .where((100 + percent) * differ <= (100 - percent) * (F.col("size") + F.col("o_size")))
                  .select("cls", "other", "size", "o_size"), "op7-near")
    other = sets.select(F.col("cls").alias("other"), "frag", F.col("grams").alias("o_grams"))
    counted = (pairs.join(other, "other").join(sets.select("cls", "frag", "grams"), ["cls", "frag"])
               .select("cls", "other", "size", "o_size", F.size(F.array_intersect("grams", "o_grams")).alias("overlap"))
               .groupBy("cls", "other", "size", "o_size").agg(F.sum("overlap").alias("overlap")))
    return counted.where((100 + percent) * F.col("overlap") >= percent * (F.col("size") + F.col("o_size"))).select("cls", "other")


#: Two sets whose n-grams before this one are equal have met there; so they meet where a common stretch begins.
_BEGINS = "(prev is null or o_prev is null or prev != o_prev)"


def _open_lists(posts: DataFrame, links: DataFrame) -> DataFrame:
    """Rows of the posting lists that hold several components, with root and the list's length n."""
    comp = saved(connected(links, "cls", "other"), "op7-roots").withColumnRenamed("node", "cls")
    placed = saved(posts.join(comp, "cls", "left").withColumn("root", F.coalesce("root", "cls")), "op7-placed")
    several = (placed.groupBy("gram").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("n"))
               .where("lo != hi").select("gram", "n"))
    return saved(placed.join(several, "gram"), "op7-open")


def _others(rows: DataFrame) -> DataFrame:
    return rows.select("gram", *[F.col(c).alias("o_" + c) for c in ("cls", "size", "pos", "prev", "root")])


def similar_sets(docs: DataFrame, n: int = N, percent: int = THRESHOLD, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id."""
    plain = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = saved(plain.mapInArrow(_sets(n), "doc_id long, n_shingles long, cls long"), "op7-rows")
    member = rows.where("doc_id is not null and n_shingles > 0").select("doc_id", "cls").distinct()
    reps = saved(member.groupBy("cls").agg(F.min("doc_id").alias("doc_id")), "op7-reps")

    chunks, sizes = deal(plain, "doc_id", "text", keys_per_byte=0.16)
    by_chunk = chunks.groupBy("chunk")
    flags = reps.select(chunk_of("doc_id", sizes).alias("chunk"), F.lit(0).alias("round"), F.lit(0).alias("bucket"),
                        F.lit(None).cast("binary").alias("vals"), "doc_id", "cls")
    asked = by_chunk.cogroup(flags.groupBy("chunk")).applyInArrow(_ask_counts(sizes, n), QUESTION)
    counted = asked.groupBy("bucket").applyInArrow(_counts, ANSWER)
    known = flags.unionByName(counted, allowMissingColumns=True)
    sets = saved(by_chunk.cogroup(known.groupBy("chunk")).applyInArrow(_cut_sets(sizes, n, percent), SETS), "op7-sets")

    posts = saved(sets.where("n_prefix > 0").select(
        "cls", "size", "start", F.inline(F.arrays_zip(
            F.slice("grams", 1, F.col("n_prefix")).alias("gram"),
            F.slice(F.concat(F.array("prev"), "grams"), 1, F.col("n_prefix")).alias("prev"),
            F.sequence(F.lit(0), F.col("n_prefix") - 1).alias("i"))))
        .select("gram", "cls", "size", (F.col("start") + F.col("i")).alias("pos"), "prev"), "op7-postings")
    lead = saved(posts.groupBy("gram").agg(F.min(F.struct("cls", "size", "pos")).alias("l"))
                 .select("gram", F.col("l.cls").alias("other"), F.col("l.size").alias("o_size"), F.col("l.pos").alias("o_pos")),
                 "op7-leaders")
    met = _passes(posts.join(lead, "gram").where("cls != other"), percent).select("cls", "other", "size", "o_size").distinct()
    first = saved(_links(saved(met, "op7-met"), sets, percent), "op7-first")

    # members of one list that are not in one component yet meet a few pivots of the list: large groups whose
    # members link here and there grow together without most of their pairs being looked at
    links = first
    for salt, few in enumerate(PIVOTS):
        left = _open_lists(posts, links)
        # a share of the hash's range, so that lists of other length that hold a group choose the same members of it
        pivots = _others(left.where((F.xxhash64("cls", F.lit(salt)) / F.lit(2.0 ** 64) + 0.5) * F.col("n") < few))
        met = _passes(left.join(pivots, "gram").where(f"cls != o_cls and root != o_root and {_BEGINS}"), percent)
        found = _links(saved(met.select("cls", F.col("o_cls").alias("other"), "size", "o_size").distinct(), "op7-met"), sets, percent)
        links = saved(links.union(found), "op7-links")
    # every pair that is left
    left = _open_lists(posts, links)
    cross = (_passes(left.join(_others(left), "gram").where(f"cls < o_cls and root != o_root and {_BEGINS}"), percent)
             .select("cls", F.col("o_cls").alias("other"), "size", "o_size").distinct())
    links = saved(links.union(_links(saved(cross, "op7-cross"), sets, percent)), "op7-links")

    # rows that repeat a doc_id tie their sets together
    twice = (member.groupBy("doc_id").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo != hi"))
    tied = member.join(twice, "doc_id").where("cls != lo").select("cls", F.col("lo").alias("other"))
    roots = connected(links.union(tied), "cls", "other")
    placed_ids = (member.join(roots.withColumnRenamed("node", "cls"), "cls", "left")
                  .select("doc_id", F.coalesce("root", "cls").alias("root")))
    least = saved(placed_ids.groupBy("root").agg(F.min("doc_id").alias("component_id")), "op7-least")
    by_doc = placed_ids.join(least, "root").groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    return (rows.join(by_doc, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))


def keep_one(docs: DataFrame, n: int = N, percent: int = THRESHOLD) -> DataFrame:
    """docs without those that have a smaller doc_id in their component; rows without a doc_id stay."""
    gone = similar_sets(docs, n, percent).where("component_id < doc_id").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("__id"), "left_anti")


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_sets(table(spark, sf_dir, "documents").select("doc_id", "text"))
