"""Fingerprints, tolerant property lookup, export values and redaction."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geopulse.functions.scoring import finite

REDACTED = "***redacted***"

# Shapes of credentials, as (pattern, replacement).
CREDENTIAL_SHAPES = (
    (r"\bhf_[A-Za-z0-9]{20,}\b", REDACTED),
    (r"(?i)\b(bearer\s+)[A-Za-z0-9._\-]{12,}", "$1" + REDACTED),
    (r"\beyJ[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{8,}\b", REDACTED),
    (r"https://hooks\.slack\.com/services/\S+", REDACTED),
    (r"https://(?:canary\.|ptb\.)?discord(?:app)?\.com/api/webhooks/\S+", REDACTED),
    (
        r"(?i)\b(api[_-]?key|map[_-]?key|security[_-]?token|token|auth|password|secret|access[_-]?key)"
        r"(=|%3D)([^&\s\"']{4,})",
        "$1$2" + REDACTED,
    ),
)
# Where a path carries a key, and what the name of a sensitive key holds.
KEY_IN_PATH = r"(?i)(/api/(?:area|data)/[a-z_]*/?)([A-Za-z0-9]{20,})(/)"
SENSITIVE_KEY_PARTS = ("secret", "token", "password", "map_key", "webhook")


def fingerprint(parts: Sequence[Column], length: int = 12) -> Column:
    """Leading hex digits of the sha-256 over pipe-joined parts."""
    joined = F.concat_ws("|", *[part.cast("string") for part in parts])
    return F.substring(F.sha2(joined, 256), 1, length)


def model_version(kind: str, revision: Column, features: Iterable[str], trees: int, seed: int) -> Column:
    """Deterministic model label: same data, parameters and features give the same version."""
    names = F.lit("[" + ", ".join(f"'{name}'" for name in sorted(features)) + "]")
    return F.concat(
        F.lit(f"{kind}:"), fingerprint([F.lit(kind), revision, names, F.lit(str(trees)), F.lit(str(seed))])
    )


def pick_property(properties: Column, *names: str) -> Column:
    """Value of a map under an exact name, else under a key the name heads."""
    exact = [F.try_element_at(properties, F.lit(name)) for name in names]
    heads = F.array(*[F.lit(name) for name in names])
    matching = F.map_filter(
        properties,
        lambda key, value: value.isNotNull()
        & (
            F.array_contains(heads, F.element_at(F.split(key, "_"), 1))
            | F.exists(heads, lambda name: F.startswith(key, F.concat(name, F.lit("_"))))
        ),
    )
    return F.coalesce(*exact, F.try_element_at(F.map_values(matching), F.lit(1)))


def _rules(secrets: Iterable[str], first: Sequence[tuple[str, str]] = ()) -> list[tuple[str, str]]:
    """All rewrites of a text in order: the caller's own secrets as one alternation, longest first, then shapes."""
    literals = sorted(set(secrets), key=lambda value: (-len(value), value))
    if any(not value for value in literals):
        raise ValueError("an empty secret would match everywhere")
    quoted = "|".join(re.sub(r"([^A-Za-z0-9_\s])", r"\\\1", value) for value in literals)
    return [*((f"(?:{quoted})", REDACTED) for _ in range(bool(quoted))), *first, *CREDENTIAL_SHAPES]


def _rewrite(text: Column, rules: Iterable[tuple[str, str]]) -> Column:
    return reduce(lambda column, rule: F.regexp_replace(column, *rule), rules, text)


def redact(text: Column, secrets: Iterable[str] = ()) -> Column:
    """Replace known secrets, however short, and credential shapes anywhere in a text column."""
    return _rewrite(text, _rules(secrets))


def redact_url(url: Column, secrets: Iterable[str] = ()) -> Column:
    """As :func:`redact`, and also a key that sits in the path."""
    return _rewrite(url, _rules(secrets, [(KEY_IN_PATH, "$1" + REDACTED + "$3")]))


# -- JSON by its tokens --------------------------------------------------------

# Tokens cover a text without gaps: keys with their colon, strings, empty and other containers, signs, blanks, bare words, stray quotes.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_TOKEN = rf'{_STRING}\s*+:|{_STRING}|\{{\s*+\}}|\[\s*+\]|[{{}}\[\],:]|\s++|[^\s"{{}}\[\],:]++|"'
_OPEN, _CLOSE, _HIT, _KEY, _BLANK, _FULL, _VOID = range(1, 8)
_CUTS = "array<struct<first: int, last: int, state: string>>"


def _kind(token: Column, hit: str) -> Column:
    is_key = F.startswith(token, F.lit('"')) & F.endswith(token, F.lit(":"))
    name = F.regexp_extract(F.lower(token), r'^"(.*)"\s*:$', 1)
    return (
        F.when(token.isin("{", "["), _OPEN).when(token.isin("}", "]", ","), _CLOSE)
        .when(is_key, F.when(name.rlike(hit), _HIT).otherwise(_KEY))
        .when(token.rlike(r"^(?:\s+|:)$"), _BLANK)
        .when(token.rlike(r'^(?:""|null|false|-?0+(?:\.0*)?(?:[eE].*)?|\{\s*\}|\[\s*\])$'), _VOID)
        .otherwise(_FULL)
    )


def _walk(tokens: Column, hit: str) -> Column:
    """Spans of tokens that are the value of a sensitive key, with what is reported in their place.

    One pass: ``skip`` counts the containers open below such a key, so nesting may be of any depth.
    """
    start = F.struct(
        F.lit(0).alias("at"), F.lit(0).alias("skip"), F.lit(False).alias("wanted"), F.lit(0).alias("first"), F.lit(None).cast(_CUTS).alias("cuts")
    )

    def cut(acc: Column, first: Column, state: Column) -> Column:
        own = F.array(F.struct(first.alias("first"), acc["at"].alias("last"), state.alias("state")))
        return F.concat(F.coalesce(acc["cuts"], F.array().cast(_CUTS)), own)

    def step(acc: Column, token: Column) -> Column:
        kind, text = token["kind"], token["text"]
        inside = acc["skip"] > 0
        ends = inside & (acc["skip"] == 1) & text.isin("}", "]")
        opens = ~inside & acc["wanted"] & (kind == _OPEN)
        scalar = ~inside & acc["wanted"] & kind.isin(_FULL, _VOID)
        skip = F.when(inside, acc["skip"] + F.when(kind == _OPEN, 1).when(text.isin("}", "]"), -1).otherwise(0)).when(opens, 1).otherwise(0)
        cuts = (
            F.when(ends, cut(acc, acc["first"], F.lit("set")))
            .when(scalar, cut(acc, acc["at"], F.when(kind == _VOID, "missing").otherwise("set"))).otherwise(acc["cuts"])
        )
        return F.struct(
            (acc["at"] + 1).alias("at"), skip.cast("int").alias("skip"),
            F.when(inside | (kind != _BLANK), ~inside & (kind == _HIT)).otherwise(acc["wanted"]).alias("wanted"),
            F.when(opens, acc["at"]).otherwise(acc["first"]).alias("first"), cuts.alias("cuts"),
        )

    def close(acc: Column) -> Column:
        # A text that stops inside such a container hides the rest.
        return F.when(acc["skip"] > 0, cut(acc, acc["first"], F.lit("set"))).otherwise(F.coalesce(acc["cuts"], F.array().cast(_CUTS)))

    return F.aggregate(F.transform(tokens, lambda t: F.struct(t.alias("text"), _kind(t, hit).alias("kind"))), start, step, close)


def redact_json(value: Column, sensitive: Iterable[str] = ()) -> Column:
    """JSON text whose values under sensitive keys, at any depth and of any kind, read ``"set"`` or ``"missing"``; all else stays as it is.

    Empty strings and containers, zero, false and null are missing. Text that is no JSON passes through by the same tokens.
    """
    hit = sensitive_pattern(sensitive)
    tokens = F.regexp_extract_all(value, F.lit(_TOKEN), F.lit(0))

    def joined(both: Column) -> Column:
        words, cuts = both["tokens"], both["cuts"]
        before = lambda i: F.when(i == 0, 0).otherwise(F.get(cuts, i - 1)["last"] + 1)
        part = lambda first, stop: F.array_join(F.slice(words, first + 1, F.greatest(stop - first, F.lit(0))), "")
        heads = F.transform(cuts, lambda c, i: F.concat(part(before(i), c["first"]), F.lit('"'), c["state"], F.lit('"')))
        return F.concat(F.array_join(heads, ""), part(before(F.size(cuts)), F.size(words)))

    both = F.transform(F.array(tokens), lambda t: F.struct(t.alias("tokens"), _walk(t, hit).alias("cuts")))
    return F.element_at(F.transform(both, joined), 1)


def sensitive_pattern(sensitive: Iterable[str] = ()) -> str:
    """What a key in lower case holds or is, if its value must not be shown."""
    parts, names = "|".join(SENSITIVE_KEY_PARTS), "|".join(re.escape(name.lower()) for name in sensitive)
    return f"^(?:{names})$|{parts}" if names else parts


def redact_map(payload: Column, sensitive: Iterable[str] = (), secrets: Iterable[str] = ()) -> Column:
    """Sensitive keys report only ``set``/``missing``; other values are redacted as text.

    A value that is itself JSON is searched for such keys at any depth; objects and lists under one count as set.
    """
    sensitive = list(sensitive)
    hit, rules = sensitive_pattern(sensitive), _rules(secrets)

    def clean(key: Column, value: Column) -> Column:
        state = F.when(F.coalesce(value, F.lit("")) != "", "set").otherwise("missing")
        opened = F.when(value.rlike(r"^\s*[\[{]"), redact_json(value, sensitive)).otherwise(value)
        return F.when(F.lower(key).rlike(hit), state).otherwise(_rewrite(opened, rules))

    return F.transform_values(payload, clean)


def export_values(df: DataFrame) -> DataFrame:
    """Values a plain-text store can hold: no NaN, decimals as doubles, ISO dates and times."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = finite(column)
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")
        elif isinstance(field.dataType, T.BooleanType):
            column = column.cast("int")
        columns.append(column.alias(field.name))
    return df.select(*columns)
