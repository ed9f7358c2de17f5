"""Ordered rules over names: J7, J8, A13, R4-R7, F10-F12, X19."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.functions.scalars import layer_order
from quillstone.functions.text import glob_match

#: Rules are broadcast only below this number; beyond it they are joined by blocks of it.
RULES_AT_ONCE = 10_000


def any_contained(text: Column, needles: list[str]) -> Column:
    """whether the text holds one of the needles, whatever their case."""
    t = F.lower(text)
    return F.exists(F.array(*map(F.lit, [n.lower() for n in needles])), lambda n: F.contains(t, n)) if needles else F.lit(False)


def included(text: Column, include: list[str], exclude: list[str]) -> Column:
    """one of ``include`` (or there are none) and none of ``exclude``."""
    return (any_contained(text, include) if include else F.lit(True)) & ~any_contained(text, exclude)


def matching_rules(names: DataFrame, rules: DataFrame, name: str = "name", glob: str = "layer_name") -> DataFrame:
    """Every pair of a name and a rule whose globs (an array) match it, as a nested loop over broadcast rules.

    Rules are a small ordered table by nature; their number is checked, and
    beyond the bound they are taken in blocks, one pass over the names each.
    """
    n = rules.count()
    blocks = max(1, -(-n // RULES_AT_ONCE))
    out = None
    for k in range(blocks):
        part = rules if blocks == 1 else rules.where(F.pmod(F.xxhash64("rule_no"), F.lit(blocks)) == k)
        hit = names.join(F.broadcast(part), F.exists(F.col(glob), lambda g: glob_match(F.col(name), g)))
        out = hit if out is None else out.unionByName(hit)
    return out


def summed_bumps(names: DataFrame, rules: DataFrame, name: str = "name") -> DataFrame:
    """Per name the sum of the matching rules' ``bump`` (0 without one) and the rules' numbers in order.

    A rule with ``order_low`` or ``order_high`` applies to layers outside the open span between them.
    """
    m = matching_rules(names, rules, name)
    applies = F.coalesce((F.col("layer") <= F.col("order_low")) | (F.col("layer") >= F.col("order_high")), F.col("order_low").isNull() & F.col("order_high").isNull())
    sums = m.where(applies).groupBy(name).agg(F.sum("bump").cast("bigint").alias("bump"), F.array_join(F.sort_array(F.collect_list("rule_no")).cast("array<string>"), ",").alias("reasons"))
    return names.join(sums, name, "left").withColumn("bump", F.coalesce("bump", F.lit(0))).withColumn("reasons", F.coalesce("reasons", F.lit("")))


def first_rule(names: DataFrame, rules: DataFrame, value: str, name: str = "name") -> DataFrame:
    """Per name the value of the first matching rule in rule order, null without one."""
    first = matching_rules(names, rules, name).groupBy(name).agg(F.min_by(value, "rule_no").alias(value))
    return names.join(first, name, "left")


def stepped(ladder: list[str], base: Column, bump: Column) -> Column:
    """The rung ``bump`` steps from ``base``, within the ladder; a base that is no rung stays."""
    rungs = F.array(*map(F.lit, ladder))
    at = F.array_position(rungs, base)
    return F.when(at > 0, F.element_at(rungs, F.greatest(F.lit(1), F.least(F.lit(len(ladder)), at + bump)).cast("int"))).otherwise(base)


def monotone_override(names: DataFrame, rules: DataFrame, quality: dict[str, int], base: str, name: str = "name") -> DataFrame:
    """In rule order a matching rule replaces the value where its quality is at least the current one's."""
    rank = F.create_map(*[x for k, v in quality.items() for x in (F.lit(k), F.lit(v))])
    of = lambda c: F.coalesce(rank[c], F.lit(0))
    m = matching_rules(names, rules, name).groupBy(name).agg(F.sort_array(F.collect_list(F.struct("rule_no", "type"))).alias("m"))
    j = names.join(m, name, "left")
    fold = F.aggregate(F.coalesce("m", F.array().cast("array<struct<rule_no:int,type:string>>")), F.col(base), lambda acc, r: F.when(of(r["type"]) >= of(acc), r["type"]).otherwise(acc))
    return j.withColumn("type", fold).drop("m")


def fallback_type(kind: Column, row_size: Column, block: int = 256) -> Column:
    """A block type whose block does not divide the row becomes a simpler one."""
    return F.when(kind.isin("Q5_K", "Q6_K") & (row_size % block != 0), "Q5_1").otherwise(kind)


def tensor_dtype(name: Column, n_dims: Column, wanted: Column) -> Column:
    """Vectors and norms stay in full precision, other tensors take the wanted type."""
    return F.when((n_dims <= 1) | name.rlike(r"norm|\.bias$|ffn_gate_inp|rope"), "F32").otherwise(wanted)


#: Types from small to large in each family, where the first one's end goes on, and types stored as another.
SMALL_LADDER = ("IQ1_S", "IQ1_M", "IQ2_XXS", "IQ2_XS", "IQ2_S", "IQ3_XXS", "IQ3_S", "IQ4_NL", "IQ4_XS")
LARGE_LADDER = ("Q2_K", "Q3_K", "Q4_K", "Q5_K", "Q6_K", "Q8_0")
OVERFLOW = ("IQ1_S", "IQ1_M", "IQ2_XXS", "IQ2_XS", "IQ2_S", "IQ3_XXS", "IQ3_S", "IQ4_NL", "IQ4_XS", "Q4_K_M", "Q5_K_M", "Q6_K", "Q8_0")
STORED_AS = {
    "IQ2_M": "IQ2_S", "IQ3_M": "IQ3_S", "IQ3_XS": "IQ3_XXS", "Q2_K_S": "Q2_K", "Q3_K_S": "Q3_K", "Q4_K_S": "Q4_K", "Q5_K_S": "Q5_K", "Q6_K_S": "Q6_K",
    "Q2_K_M": "Q2_K", "Q3_K_M": "Q3_K", "Q4_K_M": "Q4_K", "Q5_K_M": "Q5_K", "Q6_K_M": "Q6_K",
}
#: Columns of a rule; those a rule lacks are null.
RULE = "rule_no int, base_type array<string>, layer_name array<string>, bump int, bump_experts int, bump_order_low double, bump_order_high double, bump_order_val int, bump_order_experts_val int, override_types array<string>, experts boolean, order_low double, order_high double, force_type string, bump_all_max boolean"


def bump_of(is_mixture: bool) -> Column:
    """By how many rungs a matching rule raises a tensor, by its layer's place ``place`` (0..10) too; a mixture's own numbers go first."""
    first = lambda *names: F.coalesce(*(F.col(n) for n in (names if is_mixture else names[1:])), F.lit(0))
    outside = (F.col("place") <= F.col("bump_order_low")) | (F.col("place") >= F.coalesce("bump_order_high", F.lit(float("inf"))))
    return first("bump_experts", "bump") + F.when(F.coalesce(outside, F.lit(False)), first("bump_order_experts_val", "bump_order_val")).otherwise(0)


def target_type(wanted: str) -> tuple[str, tuple[str, ...]]:
    """The type a target is stored as, and its family's ladder; an unknown one falls back to the middle of the family."""
    kind = STORED_AS.get(wanted, wanted)
    ladder = SMALL_LADDER if kind.startswith("IQ") else LARGE_LADDER
    return (kind if kind in ladder else "IQ2_S" if ladder is SMALL_LADDER else "Q4_K"), ladder


def raised(wanted: str, bump: Column) -> Column:
    """The type so many rungs above the target: along its ladder, then along the overflow, its end at the most."""
    kind, ladder = target_type(wanted)
    at = ladder.index(kind) + bump
    beyond = OVERFLOW if ladder is SMALL_LADDER else ladder
    over = F.element_at(F.array(*map(F.lit, beyond)), F.least(F.lit(len(beyond)), beyond.index(kind) + bump + 1).cast("int"))
    # a place below the first counts from the end
    within = F.try_element_at(F.array(*map(F.lit, ladder)), F.when(at < 0, at).otherwise(at + 1).cast("int"))
    rung = F.when(at < len(ladder), within).otherwise(over)
    return F.coalesce(F.create_map(*[F.lit(x) for pair in STORED_AS.items() for x in pair])[rung], rung)


def tensor_types(tensors: DataFrame, rules: DataFrame, wanted: str, is_mixture: bool = False, override: str | None = None) -> DataFrame:
    """``model, position, name, current, layer, type, why`` of every tensor whose type the rules change.

    ``tensors``: ``model, position, name, current, layer`` (-1: none);
    ``rules``: as ``RULE``. Bumps of all rules for the target type (not for F32
    tensors) are added up (``why`` bump); then the first rule in order that
    overrides decides (``why`` rule): a forced type, the largest type, or
    ``override`` itself. Types named mxfp4 stay as they are (``why`` kept).
    Tensors meet the rules in a nested loop over broadcast rules.
    """
    last = tensors.groupBy("model").agg(F.max("layer").alias("_last"))
    t = tensors.join(last, "model").withColumn("place", layer_order(F.col("layer"), F.col("_last"))).drop("_last")
    kept = F.contains(F.lower("current"), F.lit("mxfp4"))
    key = ["model", "position"]
    target = STORED_AS.get(wanted, wanted)
    bumping = rules.where(F.array_contains("base_type", target)).withColumn("layer_name", F.coalesce("layer_name", F.array(F.lit("*"))))
    bumps = matching_rules(t.where(F.col("current") != "F32"), bumping).groupBy(*key).agg(F.sum(bump_of(is_mixture)).alias("bump"))
    wish = override.upper() if override else None
    asked = rules.where(F.array_contains("override_types", "*") | (F.array_contains("override_types", wish) if wish else F.lit(False)))
    asked = asked.where(F.col("experts").isNull() | (F.col("experts") == F.lit(is_mixture)))
    in_span = F.coalesce(F.col("place").between(F.col("order_low"), F.col("order_high")), F.lit(True))
    given = F.when(F.btrim("force_type") != "", F.upper(F.btrim("force_type"))).when(F.col("bump_all_max"), F.lit(None if wish in ("BF16", "F16") else "Q8_0")).otherwise(F.lit(wish))
    forced = matching_rules(t, asked).where(in_span).withColumn("given", given).where("given is not null").groupBy(*key).agg(F.min_by("given", "rule_no").alias("given"))
    j = t.join(bumps, key, "left").join(forced, key, "left")
    bumped = F.coalesce(F.col("bump") != 0, F.lit(False))
    why = F.when(kept, "kept").when(F.col("given").isNotNull(), "rule").when(bumped, "bump")
    kind = F.when(kept, "mxfp4").otherwise(F.coalesce("given", raised(wanted, F.col("bump").cast("int"))))
    return j.withColumn("why", why).withColumn("type", kind).where("why is not null").select(*key, "name", "current", "layer", "type", "why")


def type_arguments(types: DataFrame) -> DataFrame:
    """Per model the arguments of its changed tensors in order of layers, as one text; a model's tensors are a bounded list."""
    ordered = F.sort_array(F.collect_list(F.struct("layer", "position", F.concat(F.lit("--tensor-type "), "name", F.lit("="), "type").alias("a"))))
    return types.groupBy("model").agg(F.array_join(F.transform(ordered, lambda x: x["a"]), " ").alias("arguments"), F.count(F.lit(1)).alias("n"))
