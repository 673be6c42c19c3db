"""The three-hop cascade: ledger line -> tower -> application -> business unit.

All hops run in one pass over the ledger. A row that cannot be split at a hop keeps
its amount, is marked with the step and the reason, and rides through the later hops
unchanged; so allocated and residual rows come out of one plan and nothing is computed
twice. Cents are rounded at every hop, never on the product of the shares.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendfall.functions.money import (
    from_cents,
    spare_cents,
    split_floor,
    split_remainder,
    to_cents,
)
from spendfall.operators.lookup import BROADCAST_BYTES, hot_among_many, hot_keys, row_bytes, salted_join, with_slice
from spendfall.operators.strategies import (
    ANY_LINE,
    WINDOW_TARGETS,
    fallback_candidates,
    split_large_outcomes,
    usage_candidates,
)
from spendfall.operators.usage import usage_index
from spendfall.schemas import (
    ALLOCATED,
    ALLOCATION_COLUMNS,
    APP_TO_BU,
    GL_TO_TOWER,
    RESIDUAL,
    RESIDUAL_COLUMNS,
    SHARE,
    SHARED_UNATTRIBUTABLE,
    TOWER_TO_APP,
    UNMAPPED,
)
from spendfall.session import materialize
from spendfall.sources.rule_files import RuleSet

# Most targets of one source that are carried as an array next to a ledger row.
ARRAY_TARGETS = 4096
# Most targets of one source whose ranking keys are written out in the generated code.
FEW_TARGETS = 8
# In the array form remainder and place share one bigint: remainder < 2^40, place < 2^22.
_PLACES = 1 << 22
#: Ledger lines that one task splits.
LINES_PER_TASK = 50_000
#: Flows that one task of the shuffled form splits.
FLOWS_PER_TASK = 100_000
# Slices that hot sources are cut into, for every part: several of them make an even part.
_SLICES_PER_PART = 4
# Where the sides of a join lie by some of its keys, they are not shuffled again to lie by all of them.
_LIE_BY_SOME_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


@dataclass(frozen=True)
class Splits:
    """Materialized split outcomes of all versions, and which join their size allows."""

    outcomes: DataFrame
    #: Steps whose splits are too large to be handed to every task; they are joined by a shuffle.
    wide_steps: frozenset[str]
    #: Most targets of one source, of the steps for which that has been measured.
    widest: Mapping[str, int] = field(default_factory=dict)


def split_table(
    usage: DataFrame,
    towers: DataFrame,
    rules: RuleSet,
    *,
    array_targets: int = ARRAY_TARGETS,
    broadcast_bytes: int = BROADCAST_BYTES,
    window_targets: int = WINDOW_TARGETS,
) -> Splits:
    """Work out every split once, store it, and measure it to choose the join of the hops."""
    index = usage_index(usage)
    if rules.has_params:
        index = materialize(index)
    candidates = usage_candidates(index, rules)
    if rules.fallback_versions:
        candidates = candidates.unionByName(fallback_candidates(towers, rules))
    stored = materialize(split_large_outcomes(materialize(candidates), window_targets))
    return measured(stored, array_targets=array_targets, broadcast_bytes=broadcast_bytes)


def measured(
    outcomes: DataFrame, *, array_targets: int = ARRAY_TARGETS, broadcast_bytes: int = BROADCAST_BYTES
) -> Splits:
    """Measure stored outcomes in one small job: for every step their bytes and the widest source."""
    per_source = outcomes.groupBy("rule_version", "step", "from_id").agg(
        F.count(F.lit(1)).alias("targets"), F.sum(row_bytes(outcomes)).alias("bytes")
    )
    sizes = per_source.groupBy("step").agg(F.max("targets").alias("widest"), F.sum("bytes").alias("bytes")).collect()
    widest = min(array_targets, _PLACES)
    return Splits(
        outcomes,
        frozenset(row.step for row in sizes if row.widest > widest or row.bytes > broadcast_bytes),
        {row.step: row.widest for row in sizes},
    )


def _rank_key(cents: str, units: str, place: str) -> str:
    """SQL key that orders targets by remainder, then by place: the larger is served first."""
    return f"({split_remainder(cents, units)} * {_PLACES}L + ({_PLACES - 1}L - {place}))"


def _sources(outcomes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every source with the share units of its targets in one array, and its targets as rows."""
    key = ["rule_version", "from_id"]
    by_source = outcomes.groupBy(*key).agg(
        F.expr("array_sort(collect_list(CASE WHEN to_id IS NOT NULL THEN struct(place, units) END)).units AS unit_list"),
        F.max("missing").alias("missing"),
        F.max("reason_code").alias("found_reason"),
        F.count("to_id").alias("target_count"),
    )
    return by_source, outcomes.where("to_id IS NOT NULL").selectExpr(
        *key, "to_id", "share", f"{_PLACES - 1}L - place AS order", "units div 1000000L AS u1", "units % 1000000L AS u0"
    )


def _to_targets(flows: DataFrame, ranked: DataFrame, targets: DataFrame) -> DataFrame:
    """Widen flows that have their ``rank_keys`` to their targets.

    The sum of remainders stays a higher-order function, which keeps the hops in generated
    classes of their own: written out, a first run took several times as long.
    """
    remainder_sum = f"aggregate(rank_keys, 0L, (total, rank) -> total + rank div {_PLACES}L)"
    served = ranked.selectExpr(
        "*", f"CASE WHEN target_count > 0 THEN {spare_cents('cents', remainder_sum, 'missing')} ELSE 0L END AS spare"
    ).selectExpr(
        *flows.columns,
        "found_reason",
        "CASE WHEN spare > 0 THEN spare div target_count ELSE 0L END AS to_all",
        "CASE WHEN spare > 0 AND spare % target_count > 0 "
        "THEN element_at(sort_array(rank_keys), -cast(spare % target_count AS int)) END AS threshold",
    )
    kept = [c for c in flows.columns if c != "from_id"]
    wide = served.selectExpr("*", "cents div 1000000L AS c1", "cents % 1000000L AS c0").join(
        F.broadcast(targets), ["rule_version", "from_id"], "left"
    )
    # As in split_floor and split_remainder, which have the sum of the lower limbs in common.
    return (
        wide.selectExpr("*", "c1 * u0 + c0 * u1 AS middle")
        .selectExpr("*", "middle % 1000000L * 1000000L + c0 * u0 AS low")
        .selectExpr(
            *kept,
            "found_reason",
            "to_id",
            "share",
            "CASE WHEN to_id IS NULL THEN cents "
            "ELSE c1 * u1 + middle div 1000000L + low div 1000000000000L + to_all "
            f"+ CASE WHEN low % 1000000000000L * {_PLACES}L + order >= threshold THEN 1L ELSE 0L END END AS part",
        )
    )


def _expand_arrays(flows: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Row-local split by two broadcast joins: no shuffle and no sort of the widened rows.

    The first join brings the share units of the source as one array, from which each
    flow works out the ranking key that a target needs to be handed a spare cent. The
    array is dropped again, and the second join widens the flow to its targets.
    """
    by_source, targets = _sources(outcomes)
    ranked = flows.join(F.broadcast(by_source), ["rule_version", "from_id"], "left").selectExpr(
        *flows.columns,
        "found_reason",
        "missing",
        "target_count",
        f"transform(unit_list, (u, place) -> {_rank_key('cents', 'u', 'place')}) AS rank_keys",
    )
    return _to_targets(flows, ranked, targets)


def _expand_few(flows: DataFrame, outcomes: DataFrame, widest: int) -> DataFrame:
    """:func:`_expand_arrays` for sources of few targets, with their ranking keys in compiled code.

    The share units of a source are filled up with zeros to ``widest`` targets. The key of
    a filled-up target has no remainder and one of the last places, so it ranks below those
    of all others and adds nothing to their sum.
    """
    key = ["rule_version", "from_id"]
    by_source, targets = _sources(outcomes)
    by_source = by_source.withColumn("unit_list", F.expr(f"transform(sequence(0, {widest - 1}), i -> coalesce(get(unit_list, i), 0L))"))
    keys = ", ".join(_rank_key("cents", f"coalesce(unit_list[{i}], 0L)", f"{i}L") for i in range(widest))
    ranked = flows.join(F.broadcast(by_source), key, "left").selectExpr(
        *flows.columns, "found_reason", "missing", "target_count", f"array({keys}) AS rank_keys"
    )
    return _to_targets(flows, ranked, targets)


def split_amounts(amounts: DataFrame, outcomes: DataFrame) -> DataFrame:
    """How each distinct (rule_version, from_id, cents) is split: found_reason, to_id, share and part.

    A source that is hot among the flows may be hot among the amounts, hence the salt;
    each window holds the targets of one amount. An unknown source gives no row. Amounts
    that have been dealt out already (``slice``), like ``outcomes``, are split where they
    are, once for each copy of a hot one and for each finer version; those of an unknown
    source come back whole. The cents lead the keys, so that the sort compares numbers
    before it looks at texts.
    """
    key, source = ["cents", "rule_version", "from_id"], ["rule_version", "from_id"]
    targets = outcomes.drop("step").withColumnRenamed("reason_code", "found_reason")
    if "slice" in amounts.columns:
        key += ["copy", "slice", "finer_version"]
        joined = amounts.join(targets, [*source, "slice", "finer_version"], "left")
    else:
        joined = salted_join(amounts.where("from_id IS NOT NULL").select(*key).distinct(), targets, source, "inner", ["cents"])
    amount = ", ".join(key)
    counted = joined.selectExpr(
        *key,
        "found_reason",
        "to_id",
        "share",
        f"{split_floor('cents', 'units')} AS whole",
        f"{split_remainder('cents', 'units')} AS remainder",
        "missing",
        "place",
    ).selectExpr(
        *key,
        "found_reason",
        "to_id",
        "share",
        "whole",
        f"row_number() OVER (PARTITION BY {amount} ORDER BY remainder DESC, place) AS position",
        f"count(*) OVER (PARTITION BY {amount}) AS target_count",
        spare_cents("cents", f"sum(remainder) OVER (PARTITION BY {amount})", "missing") + " AS spare",
    )
    return counted.selectExpr(
        *key,
        "found_reason",
        "to_id",
        "share",
        "CASE WHEN to_id IS NOT NULL THEN whole + spare div target_count "
        "+ CASE WHEN position <= spare % target_count THEN 1L ELSE 0L END END AS part",
    )


def _expand_rows(
    flows: DataFrame, outcomes: DataFrame, flow_key: list[str], finer: Mapping[str, Sequence[str]] | None
) -> DataFrame:
    """Shuffled split for tables too wide to broadcast: amounts are split once, then joined back.

    Equal amounts of one source are split alike, so only distinct ones are widened and
    sorted. The flows are stored first: they are read for their amounts, to count the
    hot ones and to be joined. Flows, amounts and targets are dealt out once, by source and
    the slice of a hot one, and stay there while they are joined, split and joined back:
    widened rows are never shuffled. Versions part with the amounts, not with the flows;
    flows that cannot be split are not dealt out at all.
    """
    stored = materialize(flows)
    spark = stored.sparkSession
    spark.conf.set(_LIE_BY_SOME_KEYS, "false")
    source, of_amount = ["rule_version", "from_id"], ["cents", "rule_version", "from_id"]
    can_be_split = "from_id IS NOT NULL AND cents IS NOT NULL AND rule_version IS NOT NULL"
    known = stored.where(can_be_split)
    # As a given number, which is not coalesced by the size of flows that are yet to be widened.
    parts = max(spark.sparkContext.defaultParallelism, -(-known.count() // FLOWS_PER_TASK))

    def dealt(frame: DataFrame) -> DataFrame:
        return frame.repartition(parts, *source, "slice")

    hot_sources = F.broadcast(hot_keys(known, source, _SLICES_PER_PART * parts))
    copied = with_slice(known, F.broadcast(hot_among_many(known, of_amount, parts)), of_amount, flow_key, parts)
    sliced = with_slice(copied.withColumnRenamed("slice", "copy"), hot_sources, source, ["cents", "copy"], parts)
    amounts = _finer(dealt(sliced.select(*of_amount, "copy", "slice")).distinct(), finer)
    targets = outcomes.withColumnRenamed("rule_version", "finer_version")
    targets = targets.join(F.broadcast(_names(spark, finer)), "finer_version") if finer else targets.withColumn("rule_version", F.col("finer_version"))
    slices = F.sequence(F.lit(0), F.coalesce(F.col("slices"), F.lit(1)) - 1)
    targets = targets.join(hot_sources, source, "left").withColumn("slice", F.explode(slices)).drop("slices")
    split = split_amounts(amounts, dealt(targets))
    kept = [c for c in flows.columns if c != "from_id"]
    versions = ["finer_version AS rule_version" if c == "rule_version" else c for c in kept]
    joined = dealt(sliced).join(split.hint("merge"), [*of_amount, "copy", "slice"], "left").selectExpr(
        *versions, "found_reason", "to_id", "share", "CASE WHEN to_id IS NULL THEN cents ELSE part END AS part"
    )
    nothing = [f"CAST(NULL AS {kind}) AS {name}" for name, kind in (("found_reason", "string"), ("to_id", "string"), ("share", SHARE.simpleString()))]
    whole = _finer(stored.where(f"NOT ({can_be_split})"), finer).selectExpr(*versions, *nothing, "cents AS part")
    return joined.unionByName(whole)


def distribute(
    flows: DataFrame,
    splits: Splits,
    step: str,
    flow_key: list[str],
    finer: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Split the ``cents`` of every flow over the targets of its ``from_id``.

    Adds ``to_id``, ``share`` and ``part`` (bigint cents); the parts of a flow add up to
    its cents. A flow without targets comes back whole, ``to_id`` NULL, with the reason
    in ``found_reason`` (NULL if the source is not known at all). ``finer`` names the
    versions that each version of the flows parts into at this step.
    """
    outcomes = splits.outcomes.where(F.col("step") == step)
    if step in splits.wide_steps:
        return _expand_rows(flows, outcomes, flow_key, finer)
    flows = _per_version(flows, finer)
    widest = splits.widest.get(step)
    return _expand_few(flows, outcomes, widest) if widest and widest <= FEW_TARGETS else _expand_arrays(flows, outcomes)


def _hop(
    flows: DataFrame,
    splits: Splits,
    step: str,
    reached: str,
    share_name: str,
    finer: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Split every live flow at ``step``; ``from_id`` holds its source, NULL once it has failed."""
    key = [c for c in ("gl_line_id", "rule_version", "tower_id", "app_id") if c in flows.columns]
    wide = distribute(flows, splits, step, key, finer)
    replaced = ("cents", "failed_step", "reason_code")
    kept = [c for c in flows.columns if c not in ("from_id", *replaced)]
    return wide.where("to_id IS NULL OR part <> 0").selectExpr(
        *kept,
        f"CASE WHEN to_id IS NULL THEN coalesce(failed_step, '{step}') END AS failed_step",
        "CASE WHEN failed_step IS NOT NULL THEN reason_code "
        f"WHEN to_id IS NULL THEN coalesce(found_reason, '{SHARED_UNATTRIBUTABLE}') END AS reason_code",
        f"to_id AS {reached}",
        f"share AS {share_name}",
        "part AS cents",
    )


def _parting(now: Mapping[str, str], after: Mapping[str, str]) -> dict[str, list[str]] | None:
    """The versions of ``after`` that each version of ``now`` parts into; None if all stay as they are.

    Versions with the same rules up to a hop travel as one, under the name of the
    first, and part where their rules begin to differ.
    """
    parts = {name: sorted({after[v] for v in now if now[v] == name}) for name in set(now.values())}
    return None if all(names == [name] for name, names in parts.items()) else parts


def _names(spark: SparkSession, finer: Mapping[str, Sequence[str]]) -> DataFrame:
    """Versions and the finer ones they part into: as small as the rule folder."""
    pairs = [(name, version) for name, names in sorted(finer.items()) for version in names]
    return spark.createDataFrame(pairs, "rule_version string, finer_version string")


def _finer(frame: DataFrame, finer: Mapping[str, Sequence[str]] | None) -> DataFrame:
    """``frame`` with a row for every ``finer_version``."""
    if not finer:
        return frame.withColumn("finer_version", F.col("rule_version"))
    if len(finer) == 1:
        (names,) = finer.values()
        return frame.withColumn("finer_version", F.explode(F.array(*map(F.lit, names))))
    return frame.join(F.broadcast(_names(frame.sparkSession, finer)), "rule_version")


def _per_version(flows: DataFrame, finer: Mapping[str, Sequence[str]] | None) -> DataFrame:
    """Flows under the finer versions that theirs part into."""
    if not finer:
        return flows
    return _finer(flows, finer).drop("rule_version").withColumnRenamed("finer_version", "rule_version")


def spread_lines(gl: DataFrame, lines: int) -> DataFrame:
    """The ledger in even slices, each as large as one task can split into end points.

    A line becomes dozens of end points, so what a task holds must not depend on how the
    ledger is stored or which join it comes from. ``lines`` is about the number of rows.
    """
    tasks = max(gl.sparkSession.sparkContext.defaultParallelism, -(-lines // LINES_PER_TASK))
    return gl.repartition(tasks, "gl_line_id")


def gl_to_tower(gl: DataFrame, splits: Splits, rules: RuleSet, versions: Sequence[str] | None = None) -> DataFrame:
    """Hop 1: mapped lines follow their cost centre; unmapped ones fail or use the fallback.

    A ledger that has the names of its cost centres (``lineage.with_names``) keeps them.
    """
    names = sorted(set(versions or rules.versions))
    lines = gl.select(
        "gl_line_id",
        "period",
        "gl_account",
        "cost_center_id",
        *[c for c in ("cost_center_name",) if c in gl.columns],
        F.col("tower_id").alias("mapped_tower"),
        F.col("amount_eur").alias("gl_amount_eur"),
        to_cents(F.col("amount_eur")).alias("cents"),
    )
    if len(names) == 1:
        per_version = lines.withColumn("rule_version", F.lit(names[0]))
    else:
        per_version = lines.withColumn("rule_version", F.explode(F.array(*map(F.lit, names))))
    mapped = F.col("mapped_tower").isNotNull()
    one = F.lit(1).cast(SHARE)
    no_text = F.lit(None).cast("string")
    if not rules.fallback_versions:
        return per_version.select(
            *[c for c in per_version.columns if c != "mapped_tower"],
            F.when(~mapped, F.lit(GL_TO_TOWER)).alias("failed_step"),
            F.when(~mapped, F.lit(UNMAPPED)).alias("reason_code"),
            F.col("mapped_tower").alias("tower_id"),
            F.when(mapped, one).alias("gl_to_tower_proportion"),
        )
    opted_in = F.col("rule_version").isin(rules.fallback_versions)
    closed = ~mapped & ~opted_in
    flows = per_version.select(
        "*",
        F.when(closed, F.lit(GL_TO_TOWER)).alias("failed_step"),
        F.when(closed, F.lit(UNMAPPED)).alias("reason_code"),
        F.when(~mapped & opted_in, F.lit(ANY_LINE)).alias("from_id"),
    )
    # Mapped lines have no source to look up and pass through the hop whole.
    spread = _hop(flows, splits, GL_TO_TOWER, "tower_id", "gl_to_tower_proportion")
    return spread.withColumns(
        {
            "failed_step": F.when(mapped, no_text).otherwise(F.col("failed_step")),
            "reason_code": F.when(mapped, no_text).otherwise(F.col("reason_code")),
            "tower_id": F.coalesce("mapped_tower", "tower_id"),
            "gl_to_tower_proportion": F.when(mapped, one).otherwise(F.col("gl_to_tower_proportion")),
        }
    ).drop("mapped_tower")


def tower_to_app(tower_flows: DataFrame, splits: Splits, finer: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Hop 2."""
    live = tower_flows.withColumn("from_id", F.when(F.col("failed_step").isNull(), F.col("tower_id")))
    return _hop(live, splits, TOWER_TO_APP, "app_id", "tower_to_app_proportion", finer)


def app_to_bu(app_flows: DataFrame, splits: Splits, finer: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Hop 3."""
    live = app_flows.withColumn("from_id", F.when(F.col("failed_step").isNull(), F.col("app_id")))
    return _hop(live, splits, APP_TO_BU, "bu_id", "app_to_bu_proportion", finer)


def with_amount(flows: DataFrame) -> DataFrame:
    """Flows as shown to users: cents as money, and whether the flow is still alive."""
    return flows.withColumn("amount_eur", from_cents(F.col("cents"))).drop("cents")


def run_cascade(gl: DataFrame, splits: Splits, rules: RuleSet, *, in_cents: bool = False) -> DataFrame:
    """Where every cent of every ledger line ends up, one row per end point and version.

    Two versions that differ only at the last hop share the ledger scan and the first
    two hops. ``in_cents`` keeps the bigint ``cents`` instead of ``amount_eur``, for sums
    that are shown as money only when they are complete.
    """
    first, second = rules.shared([GL_TO_TOWER]), rules.shared([GL_TO_TOWER, TOWER_TO_APP])
    own = {version: version for version in rules.versions}
    towers = gl_to_tower(gl, splits, rules, list(first.values()))
    apps = tower_to_app(towers, splits, _parting(first, second))
    ends = app_to_bu(apps, splits, _parting(second, own))
    outcome = F.when(F.col("failed_step").isNull(), F.lit(ALLOCATED)).otherwise(F.lit(RESIDUAL))
    return (ends if in_cents else with_amount(ends)).withColumn("outcome", outcome)


def cascade(gl: DataFrame, usage: DataFrame, towers: DataFrame, rules: RuleSet, **limits: int) -> DataFrame:
    """Splits and cascade together, for all versions of ``rules`` in one job."""
    return run_cascade(gl, split_table(usage, towers, rules, **limits), rules)


def allocation(ends: DataFrame) -> DataFrame:
    """The allocated end points in the stored form."""
    return (
        ends.where(F.col("outcome") == ALLOCATED)
        .withColumnRenamed("amount_eur", "allocated_amount_eur")
        .select(*ALLOCATION_COLUMNS)
    )


def residual(ends: DataFrame) -> DataFrame:
    """The residual end points in the stored form."""
    return ends.where(F.col("outcome") == RESIDUAL).select(*RESIDUAL_COLUMNS)


def ends_of(allocated: DataFrame, left_over: DataFrame) -> DataFrame:
    """Put stored allocation and residual tables back into one table of end points."""
    return allocated.withColumnRenamed("allocated_amount_eur", "amount_eur").withColumn(
        "outcome", F.lit(ALLOCATED)
    ).unionByName(left_over.withColumn("outcome", F.lit(RESIDUAL)), allowMissingColumns=True)
