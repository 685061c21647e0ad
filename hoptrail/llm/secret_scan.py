"""Secrets in texts: known forms, and strings that a battery of tests finds random.

Known forms are three patterns (`KINDS`). Beside them, every run of 20 or more characters of
`[A-Za-z0-9+/_-]` (with trailing `=`) that looks like an encoding is tested against a uniform
source over that encoding's alphabet:

* chi-squared of the symbol counts, upper tail (Wilson and Hilferty's normal form);
* Wald and Wolfowitz's number of runs of symbols below and above the alphabet's middle;
* lag-1 serial correlation of the symbols' places in the alphabet.

The least of the three p-values, corrected for being the least, is the string's p. Words and
identifiers get a p near 0, random strings a uniform one. What a short string can show is
little, so false discoveries are controlled per encoding and length band: the strings with p of
a half or more tell how many random ones a band holds, and a band takes the lowest level of
`LEVELS` at which the others are expected to be at most `fdr` of what it reports.

Everything is a column expression; positions are code points, ends exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoptrail.llm.common import materialize

ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
#: For `hex` and `access`, the least length is in the pattern: a run is matched whole or not at all.
KINDS = {"assign": ASSIGN, "access": "AKIA[A-Z0-9]{16,}", "hex": "[0-9a-f]{24,}"}
LEAST_ASSIGNED = 6
CANDIDATE = "[A-Za-z0-9+/_-]{20,}={0,2}"
#: Name, pattern of the whole string, alphabet. The first that fits is the string's encoding.
ENCODINGS = [
    ("hex", "(?=.*[0-9])(?=.*[a-f])[0-9a-f]+", "0123456789abcdef"),
    ("hex_upper", "(?=.*[0-9])(?=.*[A-F])[0-9A-F]+", "0123456789ABCDEF"),
    ("base32", "(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+=*", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "(?=.*[0-9])(?=.*[a-z])[a-z0-9]+", "abcdefghijklmnopqrstuvwxyz0123456789"),
    (
        "base62",
        "(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9]+=*",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    ),
    (
        "base64",
        "(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/]+=*",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    ),
    (
        "base64_url",
        "(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9_-]+=*",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
    ),
]
BANDS = (24, 32, 48, 64, 128)
LEVELS = (0.01, 0.02, 0.05, 0.1, 0.2, 0.5)
RANDOM = "random"
SPAN = "struct<start:int,ord:int,end:int,kind:string,token:string>"


def _spans(text: Column, kind: str, order: int, pattern: str, group: int, least: int) -> Column:
    """Places of a pattern's matches: what `split` leaves between them gives the distances."""
    matches, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    tokens = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))

    def add(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        end = start + F.length(x["match"])
        span = F.struct(
            start.alias("start"),
            F.lit(order).alias("ord"),
            end.alias("end"),
            F.lit(kind).alias("kind"),
            x["token"].alias("token"),
        )
        kept = F.when(
            F.length(x["token"]) >= least, F.concat(state["spans"], F.array(span))
        ).otherwise(state["spans"])
        return F.struct(end.alias("at"), kept.alias("spans"))

    zipped = F.arrays_zip(
        F.slice(gaps, F.lit(1), F.size(matches)).alias("gap"), matches.alias("match"), tokens.alias("token")
    )
    found = F.aggregate(zipped, begin, add, lambda state: state["spans"])
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(f"array<{SPAN}>"))


def _normal_tail(z: Column) -> Column:
    """Upper tail of the normal distribution (logistic form, off by under 0.0002)."""
    z = F.least(F.greatest(z, F.lit(-8.0)), F.lit(8.0))
    return 1 / (1 + F.exp(1.5976 * z + 0.07056 * z * z * z))


def _p_random(token: Column, alphabet: str) -> Column:
    """p of the battery; symbols outside the alphabet are trailing padding."""
    k = len(alphabet)
    body = F.rtrim(token, F.lit("="))
    n = F.length(body).cast("double")
    letters = F.array(*map(F.lit, alphabet))
    squares = F.aggregate(
        letters,
        F.lit(0.0),
        lambda s, c: s + F.pow(n - F.length(F.replace(body, c, F.lit(""))), F.lit(2)),
    )
    chi = squares * k / n - n
    df = k - 1
    z_chi = (F.pow(chi / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    places = F.transform(
        F.split(body, ""), lambda c: F.instr(F.lit(alphabet), c).cast("double") - (k + 1) / 2
    )

    def neighbours(f) -> Column:
        count = F.size(places) - 1
        pairs = F.zip_with(F.slice(places, F.lit(1), count), F.slice(places, F.lit(2), count), f)
        return F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x)

    high = F.aggregate(places, F.lit(0.0), lambda s, x: s + (x > 0).cast("double"))
    mixed = 2 * high * (n - high)
    runs = 1 + neighbours(lambda a, b: ((a > 0) != (b > 0)).cast("double"))
    spread = mixed * (mixed - n) / (n * n * (n - 1))
    z_runs = F.when(spread > 0, F.abs(runs - mixed / n - 1) / F.sqrt(spread)).otherwise(F.lit(8.0))
    # A uniform place has variance (k * k - 1) / 12.
    z_serial = F.abs(neighbours(lambda a, b: a * b)) / ((k * k - 1) / 12) / F.sqrt(n - 1)
    least = F.least(_normal_tail(z_chi), 2 * _normal_tail(z_runs), 2 * _normal_tail(z_serial))
    return 1 - F.pow(1 - F.least(least, F.lit(1.0)), F.lit(3))


def _tested(span: Column) -> Column:
    """A span with its encoding's name and length band as `bucket`, and its p; nulls if none fits."""
    token, length = span["token"], F.length(span["token"])
    band = sum(((length >= limit).cast("int") for limit in BANDS), F.lit(0))
    bucket, p = F.lit(None).cast("string"), F.lit(None).cast("double")
    for name, pattern, alphabet in reversed(ENCODINGS):
        fits = token.rlike(f"^(?:{pattern})$")
        bucket = F.when(fits, F.concat(F.lit(f"{name}:"), band.cast("string"))).otherwise(bucket)
        p = F.when(fits, _p_random(token, alphabet)).otherwise(p)
    return F.struct(
        *(span[x].alias(x) for x in ("start", "ord", "end", "kind")), bucket.alias("bucket"), p.alias("p")
    )


def levels(tested: DataFrame, fdr: float) -> dict[str, float]:
    """The level of each bucket; buckets and levels are few whatever the data."""
    p = F.col("x.p")
    counts = (
        tested.select(F.explode("candidates").alias("x"))
        .groupBy("x.bucket")
        .agg(
            F.sum((p >= 0.5).cast("long")).alias("upper"),
            *(F.sum((p >= level).cast("long")).alias(f"l{i}") for i, level in enumerate(LEVELS)),
        )
        .collect()
    )
    out = {}
    for row in counts:
        # One standard deviation is allowed, else a band of few strings would report none.
        random = 2 * (row["upper"] + math.sqrt(row["upper"] + 1))
        for i, level in enumerate(LEVELS):
            if row[f"l{i}"] - (1 - level) * random <= fdr * row[f"l{i}"]:
                out[row["bucket"]] = level
                break
    return out


def find(
    df: DataFrame, text: str = "text", out: str = "secrets", fdr: float = 0.05, keep_text: bool = True
) -> DataFrame:
    """`df` with `out`: all spans, an array of (start, ord, end, kind) by start, then kind.

    Null and empty texts have no spans. Equal rows stay and are treated alike; other columns
    pass through, and `out` replaces one of its name; `keep_text=False` drops the text. A random span that overlaps one of a known
    form is left out. Texts are searched whole. Candidates are written once, as the levels need
    all of them before the first can be judged; no row is shuffled.
    """
    kept = [c for c in df.columns if c != out and (keep_text or c != text)]
    value = F.coalesce(F.col("hoptrail_text"), F.lit(""))
    base = F.concat(
        *(
            _spans(value, kind, i, pattern, *((2, LEAST_ASSIGNED) if kind == "assign" else (0, 1)))
            for i, (kind, pattern) in enumerate(KINDS.items())
        )
    )
    row = df.select(
        F.struct(*(F.col(f"`{c}`") for c in kept)).alias("hoptrail_row"),
        F.col(f"`{text}`").alias("hoptrail_text"),
    )
    found = row.select("hoptrail_row", F.array_sort(base).alias("base"), _spans(value, RANDOM, len(KINDS), CANDIDATE, 0, 1).alias("raw"))
    tested = materialize(
        found.select(
            "hoptrail_row",
            F.transform("base", lambda x: F.struct(*(x[c].alias(c) for c in ("start", "ord", "end", "kind")))).alias("base"),
            F.filter(
                F.transform(
                    F.filter(
                        "raw",
                        lambda x: ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])),
                    ),
                    _tested,
                ),
                lambda x: x["bucket"].isNotNull(),
            ).alias("candidates"),
        )
    )
    level = levels(tested, fdr)
    known = F.create_map(*(F.lit(x) for pair in level.items() for x in pair)) if level else F.create_map().cast("map<string,double>")
    added = F.transform(
        F.filter("candidates", lambda x: x["p"] >= F.coalesce(known[x["bucket"]], F.lit(2.0))),
        lambda x: F.struct(*(x[c].alias(c) for c in ("start", "ord", "end", "kind"))),
    )
    return tested.select("hoptrail_row.*", F.array_sort(F.concat("base", added)).alias("hoptrail_out")).select(
        *(F.col(f"`{c}`") for c in kept), F.col("hoptrail_out").alias(out)
    )


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")


def joined(spans: Column) -> Column:
    """`kind:start:end` of each span, comma-joined."""
    return F.concat_ws(
        ",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")))
    )


def redact(df: DataFrame, text: str = "text", spans: str = "secrets", mark: str = "[SECRET]") -> DataFrame:
    """`df` with every span of `text` replaced by `mark`; overlapping spans become one."""
    value = F.col(f"`{text}`")
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def add(state: Column, x: Column) -> Column:
        fresh = F.concat(
            state["parts"],
            F.array(F.substring(value, state["at"] + 1, x["start"] - state["at"]), F.lit(mark)),
        )
        return F.struct(
            F.greatest(state["at"], x["end"]).alias("at"),
            F.when((x["start"] >= state["at"]), fresh).otherwise(state["parts"]).alias("parts"),
        )

    def end(state: Column) -> Column:
        rest = F.substring(value, state["at"] + 1, F.length(value))
        return F.array_join(F.concat(state["parts"], F.array(rest)), "")

    return df.withColumn(text, F.when(F.size(spans) > 0, F.aggregate(F.col(spans), begin, add, end)).otherwise(value))
