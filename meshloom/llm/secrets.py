"""Secret scans: three fixed patterns, and a battery of randomness tests with length-aware false-discovery control.

Everything is built from SQL functions. Positions come from splitting the text by the pattern: the
pieces and the matches alternate, so their lengths in code points add up to the spans. SQL functions
have no running sums, so these are made in blocks of the square root of the number of matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: (kind, pattern, group that is measured, least length of it). A greedy run that is long enough is the same match as a run with that least length.
BASE = (("assign", ASSIGN, 2, 8), ("access", "AKIA[A-Z0-9]{12,}", 0, 16), ("hex", "[0-9a-f]{32,}", 0, 32))
TOKEN = "[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "random")

#: (encoding, pattern, alphabet, chance that two letters of ordinary words in it agree); the first that fits is inferred.
_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ENCODINGS = (
    ("decimal", "^[0-9]+$", _DIGITS, 1.0),
    ("hex", "^[0-9a-f]+$", _DIGITS + "abcdef", 0.12),
    ("hex", "^[0-9A-F]+$", _DIGITS + "ABCDEF", 0.12),
    ("base32", "^[A-Z2-7]+$", _UPPER + "234567", 0.065),
    ("alphanumeric", "^[A-Za-z0-9]+$", _DIGITS + _UPPER + _LOWER, 0.065),
    ("base64", "^[A-Za-z0-9+/]+$", _DIGITS + _UPPER + _LOWER + "+/", 0.065),
    ("base64url", "^[A-Za-z0-9_-]+$", _DIGITS + _UPPER + _LOWER + "_-", 0.065),
)
#: Of a document's tokens, those called not random, and those called no words, are false discoveries at most at these rates.
NOT_RANDOM, RATE = 0.001, 0.01

_SPAN = "array<struct<s:int,k:int,e:int,v:string>>"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(value: str, name: str, body: str) -> str:
    """body with `name` standing for a value that is evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _running(d: str) -> str:
    """The sums of the elements before each element of an array of integers."""
    none = "CAST(array() AS array<int>)"
    block = f"aggregate(slice({d}, c * w + 1, w), struct(0 AS s, {none} AS o), (a, v) -> struct(a.s + v AS s, concat(a.o, array(a.s)) AS o))"
    first = f"aggregate(b, struct(0 AS s, {none} AS o), (a, v) -> struct(a.s + v.s AS s, concat(a.o, array(a.s)) AS o)).o"
    whole = "flatten(transform(b, (v, c) -> transform(v.o, x -> x + f[c])))"
    return _let(f"CAST(ceil(sqrt(size({d}))) AS int)", "w", _let(f"transform(sequence(0, w - 1), c -> {block})", "b", _let(first, "f", whole)))


def _found(kind: int, pattern: str, group: int, least: int, text: str = "t") -> str:
    """The spans (s, k, e, v) of a kind in a text, as an array in order."""
    p = _quoted(pattern)
    pieces = f"struct(regexp_extract_all({text}, {p}, 0) AS m, regexp_extract_all({text}, {p}, {group}) AS g, split({text}, {p}, -1) AS between)"
    spans = f"transform(z.m, (y, i) -> struct(p[i] + char_length(z.between[i]) AS s, {kind} AS k, p[i] + d[i] AS e, z.g[i] AS v))"
    spans = _let("transform(z.m, (y, i) -> char_length(z.between[i]) + char_length(y))", "d", _let(_running("d"), "p", spans))
    return f"CASE WHEN {text} RLIKE {p} THEN filter({_let(pieces, 'z', spans)}, y -> char_length(y.v) >= {least}) ELSE CAST(array() AS {_SPAN}) END"


def _masked(pattern: str, group: int, least: int) -> str:
    """The text t with the spans of a kind blanked."""
    p = _quoted(pattern)
    pieces = f"struct(regexp_extract_all(t, {p}, 0) AS m, regexp_extract_all(t, {p}, {group}) AS g, split(t, {p}, -1) AS between)"
    inner = f"flatten(transform(z.m, (y, i) -> array(z.between[i], IF(char_length(z.g[i]) >= {least}, repeat(' ', char_length(y)), y))))"
    return _let(pieces, "z", f"concat(array_join({inner}, ''), element_at(z.between, -1))")


def _coded(spans: str) -> str:
    """Spans as strings, which SQL's set functions compare by hash; values hold no spaces."""
    return f"transform({spans}, y -> concat_ws(' ', y.s, y.e, y.v))"


#: The upper tail of the normal distribution at u.a >= 0, with u.t = 1 / (1 + 0.2316419 u.a) (fixed coefficients, error below 1e-7).
_TAIL = "exp(-u.a * u.a / 2) * 0.3989422804014327D * u.t * (0.319381530D + u.t * (-0.356563782D + u.t * (1.781477937D + u.t * (-1.821255978D + u.t * 1.330274429D))))"


def _upper(z: str) -> str:
    """The chance that a normal variable is above z."""
    return _let(f"struct(abs({z}) AS a, 1 / (1 + 0.2316419D * abs({z})) AS t, {z} AS z)", "u", f"IF(u.z >= 0, {_TAIL}, 1 - {_TAIL})")


def _step_up(p: str, rate: float, among: str) -> str:
    """How many of the first of an array of structs, in order of p, the step-up procedure rejects."""
    return f"coalesce(array_max(filter(transform({p}, (y, i) -> IF(y.p <= {rate}D * (i + 1) / {among}, i + 1, 0)), c -> c > 0)), 0)"


def _tested(tokens: str) -> list[tuple[str, str]]:
    """Stages that turn an array of tokens (s, k, e, v) into those that look random, as (name, expression)."""
    shape = lambda pick: "CASE " + " ".join(f"WHEN y.b RLIKE '{p}' THEN {pick(a, agree)}" for _, p, a, agree in ENCODINGS) + f" ELSE {pick(ENCODINGS[-2][2] + '_-', 0.065)} END"
    letters = "filter(split(y.b, ''), c -> c <> '')"
    many = "3 * sqrt(y.pairs) * (1 - 1 / (9 * y.pairs) - cbrt(y.n * (y.n - 1) / (2 * y.z) / y.pairs))"
    return [
        # body without padding, its alphabet and the chance of agreement
        ("q1", f"transform({tokens}, y -> struct(y.s AS s, y.e AS e, regexp_replace(y.v, '=+', '') AS b))"),
        ("q2", f"transform(q1, y -> struct(y.s AS s, y.e AS e, y.b AS b, CAST(char_length(y.b) AS double) AS n, {shape(lambda a, _: repr(a))} AS a, {shape(lambda _, g: f'{g}D')} AS g))"),
        ("q3", "transform(filter(q2, y -> y.n >= 16 AND y.g < 1), y -> struct(y.s AS s, y.e AS e, y.n AS n, y.g AS g, CAST(char_length(y.a) AS double) AS z,"
               f" transform({letters}, c -> CAST(locate(c, y.a) AS double)) AS x,"
               f" aggregate(array_distinct({letters}), 0D, (acc, c) -> acc + pow(y.n - char_length(replace(y.b, c, '')), 2)) AS squares))"),
        ("q4", "transform(q3, y -> struct(y.s AS s, y.e AS e, y.n AS n, y.g AS g, y.z AS z, y.x AS x, (y.squares - y.n) / 2 AS pairs, y.z / y.n * y.squares - y.n AS chi,"
               " aggregate(y.x, 0D, (acc, c) -> acc + c) / y.n AS mean, aggregate(y.x, 0D, (acc, c) -> acc + IF(c > y.z / 2, 1, 0)) AS high))"),
        # chi-squared is a straight line in the pairs of equal letters, whose number is close to a Poisson variable also where letters are few
        ("q5", f"transform(q4, y -> struct(y.s AS s, y.e AS e, y.n AS n, y.g AS g, y.z AS z, y.chi AS chi, IF(y.pairs < 1, -9D, {many}) AS many, y.high * (y.n - y.high) * 2 / y.n + 1 AS runs,"
               " aggregate(sequence(1, size(y.x) - 1), 1D, (acc, i) -> acc + IF((y.x[i] > y.z / 2) <> (y.x[i - 1] > y.z / 2), 1, 0)) AS seen,"
               " (1 / y.n + aggregate(sequence(1, size(y.x) - 1), 0D, (acc, i) -> acc + (y.x[i] - y.mean) * (y.x[i - 1] - y.mean))"
               " / greatest(1e-9D, aggregate(y.x, 0D, (acc, c) -> acc + (c - y.mean) * (c - y.mean)))) * sqrt(y.n) AS serial))"),
        # the chances of a uniform source to lie as far off in the counts, the runs and the correlation, and how far the counts lie from those of ordinary words
        ("q6", f"transform(q5, y -> struct(y.s AS s, y.e AS e, y.n AS n, {_upper('y.many')} AS p1,"
               f" IF(y.runs > 2, 2 * {_upper('abs(y.seen - y.runs) / sqrt((y.runs - 1) * (y.runs - 2) / (y.n - 1))')}, pow(2D, 1 - y.n)) AS p2, 2 * {_upper('abs(y.serial)')} AS p3,"
               " greatest(-8D, least(8D, (y.chi - (y.z * (1 + (y.n - 1) * y.g) - y.n)) / sqrt(2 * (y.z - 1) + 4 * y.n * (y.z * y.g - 1)))) AS d))"),
        ("q7", "transform(q6, y -> struct(y.s AS s, y.e AS e, y.n AS n, y.d AS d, greatest(1e-300D, y.p1) * greatest(1e-300D, y.p2) AS p12, greatest(1e-300D, y.p3) AS p3, -ln(greatest(1e-300D, y.p1)) - ln(greatest(1e-300D, y.p2)) - ln(greatest(1e-300D, y.p3)) AS l))"),
        ("q8", _let("aggregate(q7, 0D, (acc, c) -> acc + c.n) / size(q7)", "n",
                    "array_sort(transform(q7, y -> struct(exp(-y.l) * (1 + y.l + y.l * y.l / 2) * n / y.n AS p, y.s AS s, y.e AS e, y.n AS n, y.d AS d, n AS m)))")),
        # weighted step-up procedures over all tokens of the document, in which longer tokens weigh more: those that aren't random leave, and of the rest those that aren't words stay
        ("q9", f"slice(q8, 1 + {_step_up('q8', NOT_RANDOM, 'size(q8)')}, size(q8))"),
        ("q10", f"array_sort(transform(q9, y -> struct({_upper('-y.d')} * y.m / y.n AS p, y.s AS s, y.e AS e, size(q8) AS m)))"),
        ("q11", f"slice(q10, 1, {_step_up('q10', RATE, 'y.m')})"),
    ]


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random.

    Base spans are the leftmost non-overlapping matches of each pattern in the whole text. Tokens of 20
    or more characters that touch no base span are tested by their inferred encoding: the chi-squared
    statistic of the alphabet's counts, the runs above and below its middle and the correlation of
    neighbours each give the chance that a uniform source is as far off. The three are combined (minus
    twice the sum of their logarithms is chi-squared with six degrees of freedom), and a step-up procedure
    weighted by length takes out tokens that aren't random; a second one keeps those whose counts are too
    even for words, with the expected share of false ones below RATE in each document. Decimal numbers
    are never random. The work grows with the text and with the number of its matches to the power 1.5.

    Null and empty texts have no spans. Every row is kept, repeated ones and null doc_id too; equal
    texts give equal results; other columns are ignored. Row by row, no shuffle, no Python.
    """
    out = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    out = out.withColumns({kind: F.expr(_found(k, pattern, group, least)) for k, (kind, pattern, group, least) in enumerate(BASE)} | {"tokens": F.expr(_found(len(BASE), TOKEN, 0, 20))})
    # a token that touches a span isn't found at its place once the span is blanked
    out = out.withColumn("_codes", F.expr(_coded("tokens")))
    for kind, pattern, group, least in BASE:
        again = _let(_masked(pattern, group, least), "m", _coded(_found(len(BASE), TOKEN, 0, 20, "m")))
        out = out.withColumn("_codes", F.expr(f"CASE WHEN size(_codes) > 0 AND size({kind}) > 0 THEN array_intersect(_codes, {again}) ELSE _codes END"))
    out = out.drop("t", "tokens").withColumn("q0", F.expr("transform(transform(_codes, y -> split(y, ' ')), y -> struct(CAST(y[0] AS int) AS s, CAST(y[1] AS int) AS e, y[2] AS v))"))
    out = out.withColumn("base", F.array_sort(F.concat(*[F.col(kind) for kind, *_ in BASE])))
    for k, (name, expression) in enumerate(_tested("q0")):
        out = out.withColumn(name, F.expr(f"CASE WHEN size(q{k}) > 0 THEN {expression} ELSE NULL END"))
    text = lambda spans: F.array_join(F.transform(spans, lambda y: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), y["k"] + 1), y["s"].cast("string"), y["e"].cast("string"))), ",")
    whole = F.expr(f"CASE WHEN size(q11) > 0 THEN array_sort(concat(base, transform(q11, y -> struct(y.s AS s, {len(BASE)} AS k, y.e AS e, '' AS v)))) ELSE base END")
    return out.select(
        "doc_id", *[F.size(kind).cast("long").alias(f"n_{kind}") for kind, *_ in BASE],
        F.sha2(text(F.col("base")).cast("binary"), 256).alias("base_sha256"), text(whole).alias("spans"), F.greatest(F.lit(0), F.coalesce(F.size("q11"), F.lit(0))).cast("long").alias("n_random"),
    )


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(read_table(spark, sf_dir, "documents"))
