"""Expressions over chat bodies, parsed once into a variant.

A variant keeps JSON types apart (the string "false" from false) and a present
null from an absent key (a present one still overrides, S11; an absent one is
skipped, S12).  A variant column here is null where the key is absent or the
body is not JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_MIN, INT_MAX = -(2**31), 2**31 - 1


def parsed_once(payload: Column) -> Column:
    """The body as a generator output: the planner neither repeats it for each
    reference nor pushes predicates on it below, so the text is parsed once."""
    return F.explode(F.array(F.try_parse_json(payload)))


def field(v: Column, key: str) -> Column:
    return F.try_variant_get(v, f"$.{key}", "variant")


def messages(body: Column) -> Column:
    return F.try_variant_get(body, "$.messages", "array<variant>")


def is_text(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False))


def as_text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def is_assistant(m: Column) -> Column:
    role = field(m, "role")
    return is_text(role) & F.coalesce(as_text(role) == "assistant", F.lit(False))


def truthy(v: Column) -> Column:
    """Python truthiness of a JSON value: by its type, so the string "false" is
    true and the number 0 is not."""
    text = F.to_json(v)
    number = text.rlike(r"^-?[0-9]")
    zero = number & (text.try_cast("double") == 0)
    return F.coalesce(v.isNotNull() & ~text.isin("false", "null", '""', "[]", "{}") & ~F.coalesce(zero, F.lit(False)), F.lit(False))


def int_or_null(v: Column) -> Column:
    """A JSON number that fits a 32-bit integer (12.0 is 12); null for any other
    number and for strings, which the reference's insert rejects."""
    n = F.when(F.to_json(v).rlike(r"^-?[0-9]+$"), F.to_json(v).try_cast("decimal(38,0)"))
    return F.when(n.between(INT_MIN, INT_MAX), n.cast("int"))


def located_usage(body: Column) -> Column:
    """O-10: the usage object the outlet reads.  The last assistant message
    that has a ``usage`` key wins (even when its value is null); assistant
    messages without the key are skipped; otherwise the body's own usage."""
    hits = F.filter(F.reverse(messages(body)), lambda m: is_assistant(m) & field(m, "usage").isNotNull())
    hit = F.try_element_at(hits, F.lit(1))
    return F.when(hit.isNotNull(), field(hit, "usage")).otherwise(field(body, "usage"))


def first_truthy(usage: Column, *keys: str) -> Column:
    """``a or b or 0`` (S13) as a 32-bit integer, null where the chosen value is
    not one."""
    out = F.lit(0)
    for key in reversed(keys):
        v = field(usage, key)
        out = F.when(truthy(v), int_or_null(v)).otherwise(out)
    return out


def prompt_count(usage: Column) -> Column:
    return first_truthy(usage, "prompt_tokens", "prompt_eval_count")


def completion_count(usage: Column) -> Column:
    return first_truthy(usage, "completion_tokens", "eval_count")
