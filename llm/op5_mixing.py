"""Mixing sources to target weights by iterative proportional fitting.

Tokens are counted per cell (source, language, topic). The cells' weights are raked: scaled in turn
so that the sums over sources, over languages and over topics are the target shares, round by
round. A document's chance of being kept follows its cell's weight, calibrated so that the expected
tokens reach the budget; a keyed hash of its id decides, so a rerun and any partitioning keep the
same documents.

Cells are counted with partial sums, so a source that holds a third of all rows costs one row per
task; raking works on the cell table alone, which has a row per combination and none per document.
Targets not given are the natural shares raised to ``temperature``, which lifts small sources.

Topic: the kind of text by the signs that stand densest in it (``topic``), from the whole text,
unless docs has a column ``topic``. Tokens: characters / 4, at least 1.

Defined results: a null source, language or topic is a value of its own (an empty one); null or
empty text is one token; target values that no document has are left out; a value absent from given
targets gets share 0 and its documents are never kept; rows that repeat a doc_id are drawn alike,
those without one by their text; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from llm.common import saved, table

MARGINS = ("source", "lang", "topic")
ROUNDS, ROUNDS_PER_JOB = 12, 4
TEMPERATURE, SHARE, SEED = 0.5, 0.5, "mix"
DENSE = 0.02


def topic(text: Column) -> Column:
    """symbols, table or shouting if their signs are that dense (the densest, in this order), else prose."""
    def density(*marks: str) -> Column:
        left = text
        for m in marks:
            left = F.replace(left, F.lit(m), F.lit(""))
        return F.coalesce((F.length(text) - F.length(left)) / F.greatest(F.length(text), F.lit(1)), F.lit(0.0))

    return F.struct(density("$", "%", "&", "*", "#").alias("sy"), density("|").alias("tb"), density("!").alias("sh"))


def _kind(d: str) -> Column:
    sy, tb, sh = F.col(f"{d}.sy"), F.col(f"{d}.tb"), F.col(f"{d}.sh")
    return (F.when((sy >= DENSE) & (sy >= tb) & (sy >= sh), "symbols").when((tb >= DENSE) & (tb >= sh), "table")
            .when(sh >= DENSE, "shouting").otherwise("prose"))


def _placed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """docs with __source, __lang, __topic, __tokens and the draw __u in [0, 1)."""
    body, name = F.col(f"`{text}`"), F.col(f"`{doc_id}`").cast("string")
    key = F.coalesce(F.concat(F.lit(SEED + "|"), name), F.concat(F.lit(SEED + "||"), F.coalesce(body, F.lit(""))))
    out = docs.withColumns({"__d": topic(body), "__key": key})
    kind = F.col("topic").cast("string") if "topic" in docs.columns else _kind("__d")
    return out.withColumns({
        **{f"__{m}": F.coalesce(F.col(m).cast("string"), F.lit("")) for m in ("source", "lang")},
        "__topic": F.coalesce(kind, F.lit("")),
        "__tokens": F.greatest(F.lit(1), F.ceil(F.coalesce(F.length(body), F.lit(0)) / 4)).cast("long"),
        "__u": F.conv(F.substring(F.md5(F.col("__key").cast("binary")), 1, 13), 16, 10).cast("double") / float(1 << 52),
    }).drop("__d", "__key")


def natural_targets(cells: DataFrame, temperature: float) -> DataFrame:
    """(margin, value, share): natural shares raised to the temperature; rake() rescales them."""
    each = cells.select("tokens", F.inline(F.array(*[F.struct(F.lit(m).alias("margin"), F.col(m).alias("value")) for m in MARGINS])))
    return each.groupBy("margin", "value").agg(F.pow(F.sum("tokens").cast("double"), F.lit(temperature)).alias("share"))


def rake(cells: DataFrame, targets: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """cells (source, lang, topic, tokens) with weight, whose sums over each margin follow the targets' shares."""
    cur = cells.withColumn("weight", F.col("tokens").cast("double"))
    for m in MARGINS:
        goal = targets.where(F.col("margin") == m).select(F.col("value").alias(m), F.col("share").alias(f"goal_{m}"))
        cur = cur.join(goal, m, "left").withColumn(f"goal_{m}", F.coalesce(f"goal_{m}", F.lit(0.0)))
    cur = saved(cur, "op5-cells")
    # shares of the values that have cells add up to 1
    for m in MARGINS:
        total = cur.select(m, f"goal_{m}").distinct().agg(F.sum(f"goal_{m}")).first()[0] or 0.0
        cur = cur.withColumn(f"goal_{m}", F.col(f"goal_{m}") / (total or 1.0))
    for r in range(rounds):
        for m in MARGINS:
            have = F.sum("weight").over(Window.partitionBy(m))
            cur = cur.withColumn("weight", F.when(have > 0, F.col("weight") / have * F.col(f"goal_{m}")).otherwise(0.0))
        if r % ROUNDS_PER_JOB == ROUNDS_PER_JOB - 1:
            cur = saved(cur, "op5-raked")
    return saved(cur.select(*MARGINS, "tokens", "weight"), "op5-weights")


def calibrate(raked: DataFrame, budget: float) -> DataFrame:
    """raked with chance = min(1, factor * weight / tokens), the factor such that expected tokens are the budget.

    Cells that reach 1 are set aside and the factor is raised for the others until none is added;
    if all weighted cells reach 1 the budget cannot be met and every one is kept whole.
    """
    factor = 0.0
    while True:
        full = F.col("weight") * factor >= F.col("tokens")
        taken, rest = raked.where("weight > 0").agg(F.sum(F.when(full, F.col("tokens"))), F.sum(F.when(~full, F.col("weight")))).first()
        if not rest:
            break
        now = max(0.0, budget - (taken or 0)) / rest
        if now <= factor:
            break
        factor = now
    return raked.withColumn("chance", F.least(F.lit(1.0), F.col("weight") * factor / F.col("tokens")))


def mix(docs: DataFrame, targets: DataFrame | None = None, share: float = SHARE, temperature: float = TEMPERATURE,
        doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with __source, __lang, __topic, __tokens, __chance and __kept.

    targets: (margin, value, share) for the margins source, lang and topic; share: the expected part
    of all tokens that is kept.
    """
    placed = _placed(docs, doc_id, text)
    cells = saved(placed.groupBy(*[F.col(f"__{m}").alias(m) for m in MARGINS]).agg(F.sum("__tokens").alias("tokens")), "op5-counts")
    budget = share * (cells.agg(F.sum("tokens")).first()[0] or 0)
    raked = rake(cells, natural_targets(cells, temperature) if targets is None else targets)
    chance = calibrate(raked, budget).select(*[F.col(m).alias(f"__{m}") for m in MARGINS], F.col("chance").alias("__chance"))
    out = placed.join(chance, [f"__{m}" for m in MARGINS]).withColumn("__kept", F.col("__u") < F.col("__chance"))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], *[f"__{m}" for m in MARGINS], "__tokens", "__chance", "__kept")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mix(docs).select("doc_id", *[F.col(f"__{m}").alias(m) for m in MARGINS], F.col("__tokens").alias("tokens"),
                            F.round("__chance", 9).alias("chance"), F.col("__kept").alias("kept"))


def _oracle(source: str = "documents", tail: str | None = None) -> str:
    """The same in DuckDB: rounds written out; the factor by the sorted cells' running sums."""
    def density(*marks: str) -> str:
        left = "coalesce(text, '')"
        for m in marks:
            left = f"replace({left}, '{m}', '')"
        return f"(length(coalesce(text, '')) - length({left})) / greatest(length(coalesce(text, '')), 1)::double"

    steps, last = [], "w0"
    for r in range(ROUNDS):
        for m in MARGINS:
            name = f"w{r}_{m}"
            steps.append(f"{name} as materialized (select * replace (weight / sum(weight) over (partition by {m}) * goal_{m} as weight) from {last})")
            last = name
    goals = ", ".join(f"goal_{m} as (select {m}, pow(sum(tokens)::double, {TEMPERATURE}) as g, pow(sum(tokens)::double, {TEMPERATURE}) / "
                      f"sum(pow(sum(tokens)::double, {TEMPERATURE})) over () as goal_{m} from cells group by 1)" for m in MARGINS)
    joins = " ".join(f"join goal_{m} using ({m})" for m in MARGINS)
    tail = tail or ("select doc_id, source, lang, topic, tokens, round(chance, 9) as chance, u < chance as kept from chosen")
    return f"""
with dens as (select *, {density('$', '%', '&', '*', '#')} as sy, {density('|')} as tb, {density('!')} as sh from {source}),
placed as (select * exclude (sy, tb, sh) replace (coalesce(source, '') as source, coalesce(lang, '') as lang),
   case when sy >= {DENSE} and sy >= tb and sy >= sh then 'symbols' when tb >= {DENSE} and tb >= sh then 'table'
        when sh >= {DENSE} then 'shouting' else 'prose' end as topic,
   greatest(1, ceil(coalesce(length(text), 0) / 4.0))::bigint as tokens,
   ('0x' || substr(md5(coalesce('{SEED}|' || doc_id, '{SEED}||' || coalesce(text, ''))), 1, 13))::bigint / 4503599627370496.0::double as u,
   source as own_source, lang as own_lang from dens),
cells as (select source, lang, topic, sum(tokens)::bigint as tokens from placed group by all),
{goals},
w0 as (select source, lang, topic, tokens, tokens::double as weight, {', '.join(f'goal_{m}' for m in MARGINS)} from cells {joins}),
{', '.join(steps)},
ranked as (select *, tokens / weight as ratio,
   coalesce(sum(tokens) over (order by tokens / weight, source, lang, topic rows between unbounded preceding and 1 preceding), 0) as before_t,
   sum(weight) over (order by tokens / weight desc, source desc, lang desc, topic desc) as rest_w from {last} where weight > 0),
-- cells in order of the factor at which they are whole: the first whose factor is not reached fixes it
fits as (select ratio, ({SHARE} * (select sum(tokens) from cells) - before_t) / rest_w as f from ranked),
factor as (select coalesce(arg_min(f, ratio) filter (f < ratio), max(ratio)) as f from fits),
chosen as (select placed.*, least(1.0, coalesce(weight, 0) * f / c.tokens) as chance
   from placed join {last} c using (source, lang, topic), factor)
{tail}
"""


ORACLE = _oracle()
