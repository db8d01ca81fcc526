"""Question text -> intent {tags, explanation}, as column expressions.

Rules: lower-case and trim the question, then the first matching keyword
rule wins; no match gives Neutral with a fixed explanation.  Model replies
(JSON, possibly in a code fence) are validated against the tag vocabulary
and fall back to the rules when they cannot be read.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import (
    INTENT_DEFAULT_EXPLANATION,
    INTENT_DEFAULT_TAGS,
    INTENT_RULE_EXPLANATION,
    INTENT_RULES,
    REPLY_DEFAULT_EXPLANATION,
    TAG_ORDER,
)
from .scalars import strip

INTENT_TYPE = "struct<tags:array<string>,explanation:string>"


# Word characters as in Python's Unicode-aware regexes (letters, digits, _).
# Spelled out so the result does not depend on the JVM's default for \b.
_W = r"[\p{L}\p{N}_]"
_BOUNDARY = rf"(?:(?<={_W})(?!{_W})|(?<!{_W})(?={_W}))"


def java_pattern(pattern: str) -> str:
    """Rule pattern with every \\b replaced by an explicit Unicode word boundary."""
    return pattern.replace(r"\b", _BOUNDARY)


def _tag_array(tags) -> Column:
    return F.array(*[F.lit(t) for t in tags])


def rule_intent(question: Column) -> Column:
    """STRUCT<tags ARRAY<STRING>, explanation STRING> from the keyword rules."""
    q = F.lower(strip(question))
    default = F.struct(
        _tag_array(INTENT_DEFAULT_TAGS).alias("tags"),
        F.lit(INTENT_DEFAULT_EXPLANATION).alias("explanation"),
    )
    out = default
    # Build the CASE chain from the last rule upwards so the first rule wins.
    for pattern, tags in reversed(INTENT_RULES):
        hit = F.struct(
            _tag_array(tags).alias("tags"),
            F.lit(INTENT_RULE_EXPLANATION.format(tags=", ".join(tags))).alias("explanation"),
        )
        out = F.when(q.rlike(java_pattern(pattern)), hit).otherwise(out)
    # A NULL question behaves like an empty one (no rule matches).
    return F.when(question.isNull(), default).otherwise(out)


def strip_code_fence(content: Column) -> Column:
    """Trim, then drop a leading ```lang line and a trailing ``` fence."""
    c = strip(content)
    unfenced = F.regexp_replace(F.regexp_replace(c, r"^```\w*\n?", ""), r"\n?```\s*$", "")
    return F.when(c.startswith("```"), unfenced).otherwise(c)


def reply_intent(content: Column, question: Column) -> Column:
    """Validate a model reply; unreadable replies fall back to the rules.

    * tags may be a JSON list or a comma-separated string (split and trimmed);
    * tags outside the vocabulary are dropped; none left -> ["Neutral"];
    * a missing or empty explanation becomes the default sentence.
    Deviation: JSON that is not an object, or whose explanation is neither
    text nor empty, falls back to the rules.
    """
    body = strip_code_fence(content)
    parsed = F.from_json(body, "tags string, explanation string")
    # json_object_keys is NULL for malformed JSON and for JSON that is no object.
    is_object = F.json_object_keys(body).isNotNull()
    raw_tags = parsed.getField("tags")
    as_list = F.from_json(raw_tags, "array<string>")
    listed = F.when(raw_tags.startswith("["), as_list).otherwise(
        F.transform(F.split(raw_tags, ","), lambda x: strip(x))
    )
    valid = _tag_array(TAG_ORDER)
    kept = F.filter(F.coalesce(listed, F.array().cast("array<string>")),
                    lambda t: F.array_contains(valid, t))
    tags_out = F.when(F.size(kept) > 0, kept).otherwise(_tag_array(INTENT_DEFAULT_TAGS))
    expl = parsed.getField("explanation")
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(body), "$.explanation", "variant"))
    is_text = kind.isNull() | kind.isin("STRING", "VOID")
    is_empty = (F.coalesce(expl, F.lit("")) == "") | (~is_text & expl.isin("0", "0.0", "false", "[]", "{}"))
    expl_out = strip(F.when(is_empty, F.lit(REPLY_DEFAULT_EXPLANATION))
                      .otherwise(expl))
    from_reply = F.struct(tags_out.alias("tags"), expl_out.alias("explanation"))
    return F.when(is_object & (is_text | is_empty), from_reply).otherwise(rule_intent(question))
