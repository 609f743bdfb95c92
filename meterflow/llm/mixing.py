"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed into cells of (source, language, topic).  Raking rescales
the cells' token weights to one marginal after the other until they meet the
targets of all three.  A cell's sampling probability is its weight over its
tokens, calibrated so that the expected tokens meet the budget although no
probability exceeds 1.  Documents are then drawn by a hash of their id, so a
repeated or resumed run draws the same ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from meterflow.llm.components import cut, settle
from meterflow.llm.kernel import text_buffers, word_counts
from meterflow.llm.text_stats import _is, byte_counts

#: Raking rounds over the three marginals in a block, and rounds of the calibration.
ROUNDS, CALIBRATION_ROUNDS = 10, 8
#: Raking ends when a block changes the marginals' gap by less than this share; if it has not after so many blocks, it raises.
STILL, MOST_BLOCKS = 1e-7, 500
#: Share of the corpus' tokens to draw.
BUDGET = 0.5
#: Targets: each marginal's token shares to this power, made to sum to 1.
TEMPER = {"source": 0.5, "lang": 0.3, "topic": 0.8}
#: Cell tables of at most so many rows (some MB) are raked in one task and broadcast to the documents.
SMALL_CELLS = 200_000
_MARKS = {"bar": _is("|"), "digit": _is((48, 57))}


def _forms(data: np.ndarray, off: np.ndarray) -> list[str]:
    """The form of each text: table (a bar), shout (two exclamation marks in a row), figures (a digit) or prose."""
    c = byte_counts(data, off, _MARKS)
    twice = np.flatnonzero((data[1:] == 33) & (data[:-1] == 33)) + 1
    twice = twice[~np.isin(twice, off)]  # the two lie in one text
    loud = np.zeros(len(off) - 1, bool)
    loud[np.searchsorted(off, twice, side="right") - 1] = True
    return np.select([c["bar"] > 0, loud, c["digit"] > 0], ["table", "shout", "figures"], "prose").tolist()


def _count(names: list[str]):
    def run(batches):
        for b in (x for x in batches if len(x)):
            text = b.column("row").field(b.schema.field("row").type.get_field_index("text")) if "row" in names else b.column("text")
            data, off = text_buffers(text)
            topic = b.column("topic") if "topic" in b.schema.names else pa.array(_forms(data, off), pa.string())
            own = {"n_tokens": pa.array(word_counts(data, off)), "topic": topic}
            yield pa.RecordBatch.from_arrays([own[c] if c in own else b.column(c) for c in names], names)
    return run


def token_counts(docs: DataFrame, topic_of: Column | None = None, whole: bool = False) -> DataFrame:
    """``doc_id``, the cell columns (``source`` and ``lang`` with '' for null, ``topic``) and ``n_tokens``.

    Tokens are white-space separated words of the whole text.  The documents
    carry no topic: without ``topic_of`` the form of the text stands for it.
    With ``whole``, the input row comes along as the struct ``row``.
    """
    d = docs.withColumn("text", F.col("text").cast("string"))
    d = d.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
                 F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
                 *([] if topic_of is None else [F.coalesce(topic_of.cast("string"), F.lit("")).alias("topic")]),
                 F.struct("*").alias("row") if whole else F.col("text"))
    fields = {f.name: f for f in d.schema} | {"topic": StructField("topic", StringType()), "n_tokens": StructField("n_tokens", LongType())}
    names = ["doc_id", "source", "lang", "topic", "n_tokens", *(["row"] if whole else [])]
    return d.mapInArrow(_count(names), StructType([fields[c] for c in names]))


def tempered(cells: DataFrame, column: str, power: float) -> DataFrame:
    """Target shares (``column``, ``share``): the token shares to a power."""
    return cells.where("tokens > 0").groupBy(column).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("share"))


def _still(last: float | None, gap: float) -> bool:
    return gap < STILL or last is not None and abs(last - gap) < STILL


def _rake_task(names: list[str], reach: float, rounds: int):
    def run(batches):
        batches = [b for b in batches if len(b)]
        if not batches:
            return
        t = pa.Table.from_batches(batches)
        tokens, w, sides, gap = np.asarray(t.column("tokens"), np.float64), np.asarray(t.column("weight"), np.float64), [], None
        for c in names:
            code = np.asarray(t.column(c).combine_chunks().dictionary_encode().indices)
            goal = np.zeros(code.max() + 1)
            goal[code] = np.asarray(t.column(f"goal_{c}"))
            sides.append((code, goal))
        for k in range(MOST_BLOCKS * rounds):
            for code, goal in sides:
                now = np.bincount(code, w)
                w = np.minimum(tokens, w * np.divide(goal, now, out=np.zeros_like(goal), where=now > 0)[code])
            if k % rounds == rounds - 1:
                last, gap = gap, sum(np.abs(np.bincount(code, w) - goal).sum() for code, goal in sides) / reach
                if _still(last, gap):
                    break
        else:
            raise RuntimeError(f"raking has not settled: the marginals' gap is still {gap:.3g}")
        t = t.set_column(t.schema.get_field_index("weight"), "weight", pa.array(w))
        yield from t.combine_chunks().to_batches()
    return run


def rake(cells: DataFrame, targets: dict[str, DataFrame], budget: float, rounds: int = ROUNDS) -> DataFrame:
    """Add ``weight`` to ``cells`` (``tokens`` and the targets' columns) by iterative proportional fitting.

    Weights are expected tokens that meet the targets (a value and its
    ``share``) for ``budget`` of all tokens and exceed no cell's tokens.  A
    value without a target gets weight 0; one with fewer tokens than its goal
    gives all it has, and the others share the rest.  A cell is capped within the rounds, so that what it can't give
    goes to cells of the same values, until the marginals stop moving; a
    raking that doesn't settle raises.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    goals, size = {}, {}
    for c, t in targets.items():
        have = cells.where("tokens > 0").groupBy(c).agg(F.sum("tokens").alias("tokens"))
        goals[c] = cut(have.join(t.where("share > 0").select(c, F.col("share").alias("weight")), c))
        size[c] = goals[c].agg(F.sum("tokens")).first()[0] or 0
    reach = min([budget * total, *size.values()])
    if not reach:
        return cells.withColumn("weight", F.lit(0.0))
    for c, g in goals.items():
        g = calibrate(g, reach / size[c], g.count() + 1)
        cells = cells.join(g.select(c, (F.col("probability") * F.col("tokens")).alias(f"goal_{c}")), c, "left").fillna(0.0, [f"goal_{c}"])
    cells = settle(cells.withColumn("weight", F.col("tokens") * F.lit(reach / total)), "cells")
    if cells.limit(SMALL_CELLS + 1).count() <= SMALL_CELLS:  # the same rounds in one task
        return settle(cells.coalesce(1).mapInArrow(_rake_task(list(targets), reach, rounds), cells.schema), "raked").drop(*(f"goal_{c}" for c in targets))
    gap = None
    for _ in range(MOST_BLOCKS):
        for _ in range(rounds):
            for c in targets:
                now = F.sum("weight").over(Window.partitionBy(c))
                cells = cells.withColumn("weight", F.when(now > 0, F.least(F.col("tokens").cast("double"), F.col("weight") * (F.col(f"goal_{c}") / now))).otherwise(0.0))
        cells = settle(cells, "raked")
        last, gap = gap, sum(cells.groupBy(c).agg(F.abs(F.sum("weight") - F.first(f"goal_{c}")).alias("g")).agg(F.sum("g")).first()[0] for c in targets) / reach
        if _still(last, gap):
            break
    else:
        raise RuntimeError(f"raking has not settled: the marginals' gap is still {gap:.3g}")
    return cells.drop(*(f"goal_{c}" for c in targets))


def calibrate(cells: DataFrame, budget: float, rounds: int = CALIBRATION_ROUNDS) -> DataFrame:
    """Add ``probability`` to raked cells: ``weight / tokens`` scaled to the budget, 1 at most.

    What the capped cells can't give is spread over the others in proportion.
    Cells without tokens have probability 0.
    """
    n = cells.agg(F.sum("tokens").alias("t"), F.sum("weight").alias("w")).first()
    want = budget * (n["t"] or 0)
    scale, capped = want / n["w"] if n["w"] else 0.0, None
    for _ in range(rounds):
        full = F.lit(scale) * F.col("weight") >= F.col("tokens")
        m = cells.agg(F.sum(F.when(full, F.col("tokens")).otherwise(0)).alias("t"), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("w")).first()
        if not m["w"] or m["t"] == capped:  # the capped cells stay the same
            break
        capped = m["t"]
        scale = (want - m["t"]) / m["w"]
    return cells.withColumn("probability", F.expr(f"CASE WHEN tokens > 0 THEN least(1D, {scale!r}D * weight / tokens) ELSE 0D END"))


def draw(doc_id: str = "doc_id") -> Column:
    """Uniform number in [0, 1) from the id; a null id has its own."""
    return F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":mix"))), 1, 13), 16, 10).cast("double") / float(16 ** 13)


def sampling(docs: DataFrame, budget: float = BUDGET, temper: dict[str, float] | None = None, targets: dict[str, DataFrame] | None = None,
             topic_of: Column | None = None, whole: bool = False) -> DataFrame:
    """The columns of :func:`token_counts` with ``probability`` and ``sampled`` for every row.

    ``targets`` may name a table (value, ``share``) for ``source``, ``lang``
    or ``topic``; the others are tempered.  Null sources and languages count
    as ''; null, empty and wordless texts have no tokens and are never drawn;
    repeated rows are drawn together; very long texts count like any other.  An empty table gives an empty result.
    """
    names = ["source", "lang", "topic"]
    rows = token_counts(docs, topic_of, whole)
    if not whole:
        rows = settle(rows, "tokens")  # a few bytes for each document: the texts are read once
    cells = cut(rows.groupBy(*names).agg(F.sum("n_tokens").alias("tokens")))
    goals = {}
    for c in names:
        if targets and c in targets:
            goals[c] = targets[c].select(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c), F.col("share").cast("double").alias("share"))
        else:
            goals[c] = tempered(cells, c, (temper or TEMPER)[c])
    cells = cut(calibrate(rake(cells, goals, budget), budget).select(*names, "probability"))
    if cells.limit(SMALL_CELLS + 1).count() <= SMALL_CELLS:
        cells = F.broadcast(cells)
    drawn = rows.join(cells, names).withColumn("probability", F.when(F.col("n_tokens") > 0, F.col("probability")).otherwise(0.0))
    return drawn.withColumn("sampled", draw() < F.col("probability"))


def stage_mix(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: the drawn documents with ``mix_topic``, ``mix_tokens`` and ``mix_probability``.

    Rows without words are never drawn, repeated rows and rows with a null id
    are drawn together, and input columns named like the three are replaced.
    """
    added = {"mix_topic": "topic", "mix_tokens": "n_tokens", "mix_probability": "probability"}
    out = sampling(docs, whole=True).where("sampled")
    return out.select(*(F.col("row")[c].alias(c) for c in docs.columns if c not in added), *(F.col(c).alias(n) for n, c in added.items()))


def op5_source_mixing(spark, sf_dir: str) -> DataFrame:
    out = sampling(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "topic", "n_tokens", F.round("probability", 6).alias("probability"), "sampled")


def _oracle() -> str:
    parts = ["""d AS MATERIALIZED (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
    CASE WHEN contains(text, '|') THEN 'table' WHEN contains(text, '!!') THEN 'shout'
         WHEN regexp_matches(text, '[0-9]') THEN 'figures' ELSE 'prose' END AS topic,
    len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+'))::BIGINT AS n_tokens
  FROM documents)""",
             """w0 AS MATERIALIZED (
  SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM d GROUP BY ALL HAVING sum(n_tokens) > 0)""",
             f"tot AS MATERIALIZED (SELECT {BUDGET} * sum(tokens) AS want FROM w0)"]
    for c, power in TEMPER.items():
        # goals: shares of the budget, none above what its value has
        parts.append(f"v_{c} AS MATERIALIZED (SELECT {c}, sum(tokens) AS tokens, pow(sum(tokens), {power}) AS share FROM w0 GROUP BY {c})")
        parts.append(f"""f_{c}(k, scale) AS (
  SELECT 0, want / (SELECT sum(share) FROM v_{c}) FROM tot
  UNION ALL
  SELECT k + 1, CASE WHEN sum(CASE WHEN scale * share >= tokens THEN 0 ELSE share END) > 0
    THEN ((SELECT want FROM tot) - sum(CASE WHEN scale * share >= tokens THEN tokens ELSE 0 END)) / sum(CASE WHEN scale * share >= tokens THEN 0 ELSE share END)
    ELSE scale END
  FROM f_{c}, v_{c} WHERE k <= (SELECT count(*) FROM v_{c}) GROUP BY k, scale)""")
        parts.append(f"g_{c} AS MATERIALIZED (SELECT {c}, least(1.0::DOUBLE, arg_max(scale, k) * any_value(share) / any_value(tokens)) * any_value(tokens) AS goal "
                     f"FROM v_{c}, f_{c} GROUP BY {c})")
    side = [f"WHEN {i} THEN {{{i}}}" for i in range(len(TEMPER))]
    pick = f"CASE k % {len(TEMPER)} " + " ".join(side) + " END"
    key, goal = pick.format(*TEMPER), pick.format(*(f"goal_{c}" for c in TEMPER))
    steps = len(TEMPER) * ROUNDS
    off = " + ".join(f"abs(sum(w) OVER (PARTITION BY {c}) - goal_{c}) / count(*) OVER (PARTITION BY {c})" for c in TEMPER)
    goals = ", ".join(f"goal_{c}" for c in TEMPER)
    parts.append(f"""r(source, lang, topic, tokens, {goals}, w, k, last, gap) AS (
  SELECT source, lang, topic, tokens, {", ".join(f"g_{c}.goal" for c in TEMPER)}, tokens * {BUDGET}::DOUBLE, 0, NULL::DOUBLE, NULL::DOUBLE
  FROM w0 {" ".join(f"JOIN g_{c} USING ({c})" for c in TEMPER)}
  UNION ALL
  SELECT source, lang, topic, tokens, {goals}, w, k, CASE WHEN k % {steps} = 0 THEN gap ELSE last END,
    CASE WHEN k % {steps} = 0 THEN sum(off) OVER () / (SELECT want FROM tot) ELSE gap END
  FROM (SELECT *, {off} AS off
    FROM (SELECT * REPLACE (least(tokens, w * ({goal} / sum(w) OVER (PARTITION BY {key}))) AS w, k + 1 AS k)
      FROM r WHERE k % {steps} > 0 OR k < {MOST_BLOCKS * steps} AND (gap < {STILL} OR abs(last - gap) < {STILL}) IS NOT TRUE)))""")
    parts.append("raked AS MATERIALIZED (SELECT source, lang, topic, tokens, w FROM r WHERE k = (SELECT max(k) FROM r))")
    parts.append("s0 AS MATERIALIZED (SELECT any_value(want) AS want, any_value(want) / sum(w) AS scale FROM raked, tot)")
    for i in range(CALIBRATION_ROUNDS):
        parts.append(f"""s{i + 1} AS MATERIALIZED (
  SELECT want, CASE WHEN sum(CASE WHEN scale * w >= tokens THEN 0 ELSE w END) > 0
    THEN (want - sum(CASE WHEN scale * w >= tokens THEN tokens ELSE 0 END)) / sum(CASE WHEN scale * w >= tokens THEN 0 ELSE w END)
    ELSE scale END AS scale
  FROM raked, s{i} GROUP BY want, scale)""")
    parts.append(f"p AS MATERIALIZED (SELECT source, lang, topic, least(1.0::DOUBLE, scale * w / tokens) AS p FROM raked, s{CALIBRATION_ROUNDS})")
    return "WITH RECURSIVE " + ",\n".join(parts) + """
SELECT doc_id, topic, n_tokens, round(p, 6) AS probability, u < p AS sampled
FROM (SELECT doc_id, topic, n_tokens, CASE WHEN n_tokens > 0 THEN p ELSE 0 END AS p,
  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':mix'), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u
  FROM d LEFT JOIN p USING (source, lang, topic))
"""


ORACLE_OP5 = _oracle()
