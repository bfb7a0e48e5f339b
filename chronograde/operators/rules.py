"""Declarative validation of documents.

A rule set is a handful of Python objects known when the plan is built, so rules become column
expressions over the metadata map: validation is a map-only step inside the extraction stage. There is
no rules table to join, no cross product of rules and files, and no shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronograde import fixed_values as fv
from chronograde.functions.text import format_weight, trimmed, weight_number


@dataclass(frozen=True)
class Rule:
    """One labelled field. ``value_range`` and ``kind`` are only used by the optional checks."""

    name: str
    required: bool = False
    allowed: Sequence[str] | None = None
    default: str | None = None
    value_range: tuple[float, float] | None = None
    kind: str = "str"


@dataclass(frozen=True)
class RuleSet:
    """Rules plus switches. Range, length, row-count and kind checks are off unless asked for."""

    rules: Sequence[Rule] = ()
    equal_lengths: Sequence[str] = (fv.INDUSTRY_FIELD, fv.SCORE_FIELD, fv.WEIGHT_FIELD)
    expected_rows: int | None = 6
    allocation_total: float | None = 100.0
    optional_checks: frozenset[str] = field(default_factory=frozenset)

    def default(self, name: str) -> str | None:
        return next((r.default for r in self.rules if r.name == name), None)


def standard_rules() -> RuleSet:
    """The full rule set for rating workbooks."""
    graded = dict(required=True, allowed=fv.GRADES)
    return RuleSet((
        Rule("Rated entity", required=True),
        Rule("CorporateSector", required=True, allowed=fv.SECTORS),
        Rule("Rating methodologies applied", required=True, allowed=fv.METHODOLOGIES),
        Rule(fv.INDUSTRY_FIELD, required=True, allowed=fv.INDUSTRIES, kind="list"),
        Rule(fv.SCORE_FIELD, allowed=fv.SCORES, default=""),
        Rule(fv.WEIGHT_FIELD, default="0", value_range=(0.0, 1.0)),
        Rule("Segmentation criteria", required=True, allowed=fv.SEGMENTATIONS),
        Rule("Reporting Currency/Units", required=True, allowed=fv.CURRENCIES),
        Rule("Country of origin", required=True, allowed=fv.COUNTRIES),
        Rule("Accounting principles", required=True, allowed=fv.ACCOUNTING),
        Rule("End of business year", required=True, allowed=fv.MONTHS),
        Rule("Business risk profile", **graded),
        Rule("(Blended) Industry risk profile", **graded),
        Rule("Competitive Positioning", **graded),
        Rule("Market share", **graded),
        Rule("Diversification", **graded),
        Rule("Operating profitability", **graded),
        Rule("Sector/company-specific factors (1)", **graded),
        Rule("Sector/company-specific factors (2)", allowed=[*fv.GRADES, ""], default=""),
        Rule("Financial risk profile", **graded),
        Rule("Leverage", **graded),
        Rule("Interest cover", **graded),
        Rule("Cash flow cover", **graded),
        Rule("Liquidity", required=True, allowed=fv.NOTCHES),
    ))


def load_rules(path: str | Path) -> RuleSet:
    """Rules from a YAML (needs PyYAML) or JSON file; a missing or empty file gives an empty rule set."""
    file = Path(path)
    if not file.exists():
        return RuleSet()
    text = file.read_text(encoding="utf-8")
    if file.suffix == ".json":
        raw = json.loads(text or "{}")
    else:
        import yaml  # optional dependency

        raw = yaml.safe_load(text) or {}
    anchors = raw.get("extraction_meta", {}).get("anchors", [])
    rules = tuple(
        Rule(
            a["name"], bool(a.get("required", False)), a.get("allowed_values"), a.get("default"),
            tuple(float(x) for x in a["range"]) if a.get("range") else None, a.get("type", "str"),
        )
        for a in anchors
    )
    lengths = [c for c in raw.get("cross_validation", []) if c.get("rule_type") == "equal_lengths"]
    tables = raw.get("tables", [])
    return RuleSet(
        rules,
        equal_lengths=tuple(lengths[0]["fields"]) if lengths else (),
        expected_rows=tables[0].get("expected_rows") if tables else None,
    )


# --- expressions over metadata map<string,array<string>> -----------------------------------------


def _none() -> Column:
    return F.array().cast("array<string>")


def values_of(name: str) -> Column:
    """Values of a field; a missing or blank field is an empty array."""
    return F.coalesce(F.try_element_at("metadata", F.lit(name)), _none())


def required_errors(rule: Rule) -> Column:
    if not rule.required:
        return _none()
    missing = F.size(values_of(rule.name)) == 0
    return F.when(missing, F.array(F.lit(f"Missing mandatory field: '{rule.name}'"))).otherwise(_none())


def domain_errors(rule: Rule) -> Column:
    """One message per element outside the allowed values."""
    if rule.allowed is None:
        return _none()
    outside = F.filter(values_of(rule.name), lambda v: ~trimmed(v).isin(list(rule.allowed)))
    return F.transform(
        outside, lambda v: F.concat(F.lit(f"Value violation on '{rule.name}': Element '"), v, F.lit("' is out of bounds."))
    )


def boundary_errors(rules: RuleSet) -> Column:
    """Required and domain messages in rule order."""
    parts = [p for r in rules.rules for p in (required_errors(r), domain_errors(r)) if r.required or r.allowed]
    return F.concat(*parts) if parts else _none()


def padded(name: str, rules: RuleSet, width: Column, prepare=lambda v: v) -> Column:
    """The field's vector, extended with its default to ``width`` elements."""
    vals = F.transform(values_of(name), prepare)
    fill = F.array_repeat(F.lit(rules.default(name)).cast("string"), width - F.size(vals))
    return F.concat(vals, fill)


def vector_width() -> Column:
    return F.greatest(*[F.size(values_of(n)) for n in (fv.INDUSTRY_FIELD, fv.SCORE_FIELD, fv.WEIGHT_FIELD)])


def zipped_industries(rules: RuleSet) -> Column:
    """``array<struct<sector, weight, score>>`` of the three padded vectors, weights as labels.

    Only given weights are formatted; the default used for padding is already a label.
    """
    width = vector_width()
    sector = padded(fv.INDUSTRY_FIELD, rules, width)
    score = padded(fv.SCORE_FIELD, rules, width)
    weight = padded(fv.WEIGHT_FIELD, rules, width, format_weight)
    zipped = F.arrays_zip(sector.alias("sector"), weight.alias("weight"), score.alias("score"))
    return F.transform(zipped, lambda z: F.struct(
        z["sector"].alias("sector"),
        F.coalesce(z["weight"], F.lit("0%")).alias("weight"),
        F.coalesce(z["score"], F.lit("")).alias("score"),
    ))


def allocation_sum(industries: Column) -> Column:
    return F.aggregate(
        industries, F.lit(0.0), lambda total, i: total + F.coalesce(weight_number(i["weight"]), F.lit(0.0))
    )


def allocation_errors(industries: Column, total: float | None) -> Column:
    """Unreadable weights, else a sum (two digits) other than ``total``."""
    if total is None:
        return _none()
    unreadable = F.filter(industries, lambda i: weight_number(i["weight"]).isNull())
    summed = allocation_sum(industries)
    off = F.concat(
        F.lit("Mathematical allocation error: Combined weights sum to "), summed.cast("string"),
        F.lit(f"% instead of {total:g}%."),
    )
    return (
        F.when(F.size(unreadable) > 0, F.transform(unreadable, lambda _: F.lit(fv.MSG_PARSE)))
        .when(F.round(summed, 2) != total, F.array(off))
        .otherwise(_none())
    )


def _optional_errors(rules: RuleSet) -> list[Column]:
    checks = {
        "range": [range_errors(r) for r in rules.rules if r.value_range],
        "equal_lengths": [length_errors(rules)] if rules.equal_lengths else [],
        "expected_rows": [row_count_errors(rules)] if rules.expected_rows is not None else [],
        "type": [kind_errors(r) for r in rules.rules],
    }
    return [c for name in checks if name in rules.optional_checks for c in checks[name]]


def range_errors(rule: Rule) -> Column:
    lo, hi = rule.value_range
    outside = F.filter(
        values_of(rule.name), lambda v: ~F.coalesce(v.try_cast("double").between(lo, hi), F.lit(False))
    )
    return F.transform(
        outside, lambda v: F.concat(F.lit(f"Range violation on '{rule.name}': Element '"), v, F.lit(f"' is not in [{lo:g}, {hi:g}]."))
    )


def length_errors(rules: RuleSet) -> Column:
    sizes = [F.size(values_of(n)) for n in rules.equal_lengths]
    text = F.concat(
        F.lit("Unequal lengths: "),
        F.concat_ws(", ", *[F.concat(F.lit(f"'{n}'="), s.cast("string")) for n, s in zip(rules.equal_lengths, sizes)]),
    )
    return F.when(F.greatest(*sizes) != F.least(*sizes), F.array(text)).otherwise(_none())


def row_count_errors(rules: RuleSet) -> Column:
    n = F.size("metric_rows")
    text = F.concat(F.lit("Metric table has "), n.cast("string"), F.lit(f" rows instead of {rules.expected_rows}"))
    return F.when(n != rules.expected_rows, F.array(text)).otherwise(_none())


def kind_errors(rule: Rule) -> Column:
    """A field declared as single text must not hold a list."""
    if rule.kind != "str":
        return _none()
    text = F.lit(f"Type violation on '{rule.name}': single value expected")
    return F.when(F.size(values_of(rule.name)) > 1, F.array(text)).otherwise(_none())


def validate(docs: DataFrame, rules: RuleSet) -> DataFrame:
    """Add ``industries``, ``errors`` (boundary, then allocation, then optional) and ``is_valid``.

    Needs the ``metadata`` map; ``metric_rows`` only for the optional row-count check. The cleaned
    industry vector is returned whether or not the document is valid.
    """
    zipped = docs.withColumn("industries", zipped_industries(rules))
    errors = F.concat(
        boundary_errors(rules),
        allocation_errors(F.col("industries"), rules.allocation_total),
        *_optional_errors(rules),
    )
    return zipped.withColumn("errors", errors).withColumn("is_valid", F.size("errors") == 0)


def error_text(errors: Column) -> Column:
    return F.array_join(errors, "; ")
