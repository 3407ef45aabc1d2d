"""The row-at-a-time quality steps: required fields, type coercion, null
handling and field validation. All are narrow projections inside one codegen
stage; the same functions serve batch and streaming frames."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..config import FieldValidation, TypeCoercion
from ..functions import dates, text
from ..functions.numbers import as_double, field_or_null, is_text
from .verdict import FAILURES, LIVE, data_columns, fail_rows, failure, with_verdict

REQUIRED = "RequiredFieldValidator"
NULLS = "NullHandlerOperator"
VALIDATION = "FieldValidationOperator"


def required_fields(df: DataFrame, fields: Iterable[str]) -> DataFrame:
    """Dead-letter rows on the first listed field that is null or blank."""
    df = with_verdict(df)
    checks = [
        F.when(text.null_or_blank(field_or_null(df, name), is_text(df, name)), F.lit(f"Field '{name}' is null or blank"))
        for name in fields
    ]
    return fail_rows(df, REQUIRED, "MISSING_REQUIRED_FIELD", F.coalesce(*checks)) if checks else df


def _coercion(rule: TypeCoercion, column: Column) -> Column | None:
    pair = {rule.from_type, rule.to_type}
    if (rule.from_type, rule.to_type) == ("ISO8601_STRING", "EPOCH_MILLIS"):
        return dates.iso_to_epoch_text(column)
    if (rule.from_type, rule.to_type) == ("LOWERCASE_STRING", "UPPERCASE_ENUM"):
        return text.upper_symbol(column)
    if "TRIM_STRING" in pair:
        return text.trim_controls(column)
    if "NUMERIC_STRING" in pair:
        return text.keep_number_chars(column)
    return None


def coerce_types(df: DataFrame, rules: Iterable[TypeCoercion]) -> DataFrame:
    """Rewrite text fields in place. Absent or non-text fields and unknown pairs
    stay as they are, as does any value that does not convert."""
    for rule in rules:
        if rule.field not in df.columns or not is_text(df, rule.field):
            continue
        rewritten = _coercion(rule, F.col(f"`{rule.field}`"))
        if rewritten is not None:
            df = df.withColumn(rule.field, rewritten)
    return df


def _typed_default(df: DataFrame, name: str, default: str) -> Column:
    """Configured defaults are text; one that does not fit the type acts as null."""
    dtype = df.schema[name].dataType
    return F.lit(default) if isinstance(dtype, T.StringType) else F.lit(default).try_cast(dtype)


def handle_nulls(df: DataFrame, strategy: str, defaults: Mapping[str, str] | None = None) -> DataFrame:
    defaults = defaults or {}
    if strategy == "FORWARD":
        return df
    names = data_columns(df)
    if strategy == "DROP_RECORD":
        df = with_verdict(df)
        checks = [
            F.when(F.col(f"`{name}`").isNull(), F.lit(f"Field '{name}' is null and strategy is DROP_RECORD"))
            for name in names
            if name not in defaults
        ]
        if checks:
            df = fail_rows(df, NULLS, "NULL_FIELD_DROP", F.coalesce(*checks))
    fills = {
        name: F.coalesce(F.col(f"`{name}`"), _typed_default(df, name, default))
        for name, default in defaults.items()
        if name in names
    }
    return df.withColumns(fills) if fills else df


def check_pattern(df: DataFrame, rule: FieldValidation) -> None:
    """A pattern that the engine's own dialect refuses stops the job when its plan is built."""
    try:
        df.sparkSession._jvm.java.util.regex.Pattern.compile(rule.pattern)
    except IllegalArgumentException as error:
        raise ValueError(f"the pattern {rule.pattern!r} of field {rule.field!r} does not compile") from error


def passes(df: DataFrame, rule: FieldValidation) -> Column:
    """True or false, never null, for one rule on the field's current value."""
    value = field_or_null(df, rule.field)
    if rule.rule == "NOT_EMPTY":
        return ~text.null_or_blank(value, is_text(df, rule.field))
    if rule.rule == "REGEX":
        if not rule.pattern or not rule.pattern.strip():
            return F.lit(False)
        check_pattern(df, rule)
        return F.coalesce(text.full_match(value.cast("string"), rule.pattern), F.lit(False))
    if rule.rule == "RANGE":
        number = as_double(df, rule.field)
        inside = number.isNotNull()
        if rule.min is not None:
            inside = inside & (number >= F.lit(float(rule.min)))
        if rule.max is not None:
            inside = inside & (number <= F.lit(float(rule.max)))
        if rule.min is not None or rule.max is not None:
            inside = inside & ~F.isnan(number)
        return F.coalesce(inside, F.lit(False))
    return F.coalesce(value.cast("string").isin(*(rule.allowed_values or [])), F.lit(False))


def validate_fields(df: DataFrame, rules: Iterable[FieldValidation]) -> DataFrame:
    """Apply the rules in order; a later rule sees what an earlier one filled."""
    df = with_verdict(df)
    for rule in rules:
        if rule.on_fail == "FORWARD":
            continue
        passed = passes(df, rule)
        if rule.on_fail == "FILL_DEFAULT":
            if rule.default_value is not None and rule.field in df.columns:
                filled = _typed_default(df, rule.field, rule.default_value)
                df = df.withColumn(rule.field, F.when(passed, F.col(f"`{rule.field}`")).otherwise(filled))
            continue
        failed = F.col(LIVE) & ~passed
        changes = {LIVE: F.col(LIVE) & passed}
        if rule.on_fail == "DLQ":
            shown = F.coalesce(field_or_null(df, rule.field).cast("string"), F.lit("null"))
            message = F.concat(F.lit(f"Field '{rule.field}' failed {rule.rule} (value="), shown, F.lit(")"))
            entry = failure(VALIDATION, f"{rule.rule}_FAIL", message)
            changes[FAILURES] = F.when(failed, entry).otherwise(F.col(FAILURES))
        df = df.withColumns(changes)
    return df


def rewritten_fields(quality) -> list[str]:
    """Fields that coercion, null filling or validation may overwrite."""
    names = [rule.field for rule in quality.type_coercions]
    if quality.null_strategy != "FORWARD":
        names += list(quality.field_defaults)
    names += [rule.field for rule in quality.field_validations if rule.on_fail == "FILL_DEFAULT"]
    return list(dict.fromkeys(names))
