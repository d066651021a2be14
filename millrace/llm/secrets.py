"""Secret scan in DataFrame functions only.

Fixed patterns give the base spans. The method adds spans: long tokens are taken as a draw from
the alphabet of their encoding (a value assigned with ``=`` is a token of its own; a token that has
``+`` or ``/`` and also ``-`` or ``_`` is in no encoding, so its runs without the one or the other or
both are taken), and three tests ask whether they look random: a
chi-squared test that all symbols are equally likely, a runs test about the middle of the
alphabet, and the correlation of neighbouring symbols. Fisher's sum joins the three p values, and
a token below ``BATTERY_LEVEL`` is not random.

What passes need not be a secret: names and joined words are too short for such tests. So each
token is also held against ordinary ones: the corpus itself tells how likely a letter is after
another (pairs of letters in all words of all texts), and fixed shares how often letters, digits
and signs follow each other and cases change. The ratio of a token's likelihood as a uniform draw
to that as an ordinary token has the mean 1 over ordinary tokens, so ordinary tokens reach a ratio
r in 1 of r cases at most, and 1/r is a p value under "ordinary". The Benjamini-Hochberg rule on
these, within each class of lengths, makes the secrets the discoveries: among those reported,
ordinary tokens are expected to be ``FALSE_DISCOVERIES`` at most, and long tokens, which tell
more, do not set the level for short ones. A token that is discovered, that the tests do not
refuse and that holds enough bits is a span of kind ``random``, unless it lies within a longer
one; runs of one token may overlap, and both are listed.

All positions are code points, ends exclusive. Null and empty texts have no spans and the
checksum of the empty list. Repeated rows are scanned one by one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import table, texts
from millrace.session import store

# Kinds in the order in which equal starts are listed.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"()(AKIA[A-Z0-9]+)"
# A run of one character class can only be matched from its first character on.
HEX = r"()((?<![0-9a-f])[0-9a-f]{32,})"
PATTERNS = {"assign": (ASSIGN, 8), "access": (ACCESS, 16), "hex": (HEX, 32)}
MIN_TOKEN = 20
# An equals sign ends a token, or pads it where nothing follows.
TOKEN = rf"()((?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{MIN_TOKEN},}}(?:=+(?![A-Za-z0-9+/_=-]))?)"
RUNS = [rf"()([{c}]{{{MIN_TOKEN},}})" for c in ("A-Za-z0-9+/", "A-Za-z0-9_-", "A-Za-z0-9")]
MIN_BITS = 64
FALSE_DISCOVERIES = 0.05
BATTERY_LEVEL = 0.001

# Ordinary tokens: shares with which a letter, digit or sign follows another, and of letters that
# keep the case of the letter before.
FOLLOWS = {"letter": (0.93, 0.03, 0.04), "digit": (0.02, 0.96, 0.02), "sign": (0.8, 0.15, 0.05)}
SAME_CASE = 0.9
# Added to each count of a pair of letters.
PRIOR = 0.5

# Alphabets by encoding, each in the order of its symbols' values.
DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
# The narrowest encodings come first.
ALPHABETS = {
    "decimal": DIGITS,
    "hex": DIGITS + "abcdef",
    "hex_upper": DIGITS + "ABCDEF",
    "base32": LOWER.upper() + "234567",
    "base36": DIGITS + LOWER,
    "base36_upper": DIGITS + LOWER.upper(),
    "base62": DIGITS + LOWER.upper() + LOWER,
    "base64": LOWER.upper() + LOWER + DIGITS + "+/",
    "base64_url": LOWER.upper() + LOWER + DIGITS + "-_",
}


SPANS = "array<struct<start:int,kind:int,end:int,value:string>>"


def marked(text: Column, pattern: str, only_if: Column) -> Column:
    """The text with a mark before, within and after each match (a lead and a value group).

    ``only_if`` is a cheap test that every text with a match passes."""
    return F.when(only_if, F.regexp_replace(text, pattern, "\x01$1\x02$2\x01")).otherwise("")


def spans(marked_text: Column, kind: str, least: int) -> Column:
    """The marked matches whose value has ``least`` characters.

    The text is cut at the marks; a piece's place is the length of all before it."""

    def step(state: Column, piece: Column) -> Column:
        value = F.substring_index(piece, "\x02", -1)
        is_match = F.instr(piece, "\x02") > 0
        end = state["at"] + F.length(piece) - is_match.cast("int")
        found = F.struct(
            state["at"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"), value.alias("value")
        )
        more = F.concat(state["found"], F.array(found))
        return F.struct(
            end.alias("at"), F.when(is_match & (F.length(value) >= least), more).otherwise(state["found"]).alias("found")
        )

    none = F.array().cast(SPANS)
    start = F.struct(F.lit(0).alias("at"), none.alias("found"))
    walked = F.aggregate(F.split(marked_text, "\x01", -1), start, step, lambda s: s["found"])
    return F.when(F.contains(marked_text, F.lit("\x02")), walked).otherwise(none)


def in_some_encoding(tokens: Column) -> Column:
    """``tokens`` with the runs of those that fit no encoding in their place."""

    def runs(t: Column, pattern: str) -> Column:
        found = spans(marked(t["value"], pattern, F.lit(True)), "random", MIN_TOKEN)
        moved = lambda s: F.struct(
            (t["start"] + s["start"]).alias("start"), s["kind"].alias("kind"), (t["start"] + s["end"]).alias("end"), s["value"].alias("value")
        )
        return F.transform(found, moved)

    def fitting(t: Column) -> Column:
        mixed = t["value"].rlike("[+/]") & t["value"].rlike("[-_]")
        return F.when(mixed, F.concat(*[runs(t, p) for p in RUNS])).otherwise(F.array(t))

    return F.array_distinct(F.flatten(F.transform(tokens, fitting)))


def all_spans(docs: DataFrame) -> DataFrame:
    """doc_id, the base spans by kind, and the tokens that the tests are to judge.

    The marks are control characters that no pattern can match; where a text holds them itself
    they first become another one, so that no position moves."""
    has = lambda c: F.contains(F.col("text"), F.lit(c))
    clean = F.when(has("\x01") | has("\x02"), F.translate("text", "\x01\x02", "\x03\x03")).otherwise(F.col("text"))
    df = texts(docs).withColumn("text", clean)
    text = F.col("text")
    df = df.select(
        "doc_id",
        marked(text, PATTERNS["assign"][0], has(":") | has("=")).alias("assign"),
        marked(text, PATTERNS["access"][0], has("AKIA")).alias("access"),
        marked(text, PATTERNS["hex"][0], F.lit(True)).alias("hex"),
        marked(text, TOKEN, F.lit(True)).alias("tokens"),
    )
    return df.select(
        "doc_id",
        *[spans(F.col(kind), kind, least).alias(kind) for kind, (_, least) in PATTERNS.items()],
        spans(F.col("tokens"), "random", MIN_TOKEN).alias("tokens"),
    ).withColumn("tokens", in_some_encoding(F.col("tokens")))


def listed(of: Column) -> Column:
    """``kind:start:end`` by start, then kind, joined with commas."""
    names = F.array(*map(F.lit, KINDS))
    parts = F.transform(
        F.array_sort(of),
        lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(parts, ",")


def encoding(value: Column) -> Column:
    """The symbols of the first, so the narrowest, encoding that has all of the value's."""
    out = None
    for symbols in ALPHABETS.values():
        test = value.rlike("^[" + symbols.replace("-", "\\-") + "]+$")
        out = F.when(test, symbols) if out is None else out.when(test, symbols)
    return out


def upper_tail(z: Column) -> Column:
    """P(Z > z) of the normal law, by a logistic fit that is good to 2e-4."""
    z = F.greatest(F.lit(-9.0), F.least(F.lit(9.0), z))
    return 1 / (1 + F.exp(z * 1.5976 + z * z * z * 0.070566))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _pairs(codes: Column, fn) -> Column:
    """``fn`` of each symbol but the last and the one after it."""
    return F.zip_with(F.slice(codes, F.lit(1), F.size(codes) - 1), F.slice(codes, F.lit(2), F.size(codes) - 1), fn)


def letter_pairs(docs: DataFrame) -> list[float]:
    """Logarithm of the share of each letter after each other letter (row 26: at the beginning of
    a word), row by row, over all words of all texts. The words are counted first, so that pairs
    are cut from different words only; the driver gets 702 numbers."""
    words = texts(docs).select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("word")).where("word <> ''")
    words = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    letters = F.split("word", "")
    pairs = F.arrays_zip(F.concat(F.array(F.lit("^")), F.slice(letters, F.lit(1), F.length("word") - 1)).alias("a"), letters.alias("b"))
    counted = words.select(F.inline(pairs), "n").toDF("a", "b", "n").groupBy("a", "b").agg(F.sum("n").alias("n"))
    counts = [PRIOR] * (27 * 26)
    for r in counted.collect():
        counts[(26 if r["a"] == "^" else LOWER.index(r["a"])) * 26 + LOWER.index(r["b"])] += r["n"]
    rows = [sum(counts[i : i + 26]) for i in range(0, 27 * 26, 26)]
    return [math.log(c / rows[i // 26]) for i, c in enumerate(counts)]


def ordinary(value: Column, pairs: list[float]) -> Column:
    """Logarithm of a token's likelihood as an ordinary one."""
    table_ = F.array(*[F.lit(p) for p in pairs])
    follows = F.array(*[F.lit(math.log(p)) for of in FOLLOWS.values() for p in of])
    code = F.ascii
    is_letter, is_digit = lambda c: c.rlike("^[A-Za-z]"), lambda c: c.rlike("^[0-9]")
    kind = lambda c: F.when(is_letter(c), 0).when(is_digit(c), 1).otherwise(2)
    # Of each symbol: its kind, the place of its letter, whether it is a capital.
    symbols = F.transform(
        F.split(value, ""), lambda c: F.struct(kind(c).alias("kind"), (code(F.lower(c)) - 97).alias("place"), c.rlike("^[A-Z]").alias("capital"))
    )

    def step(before: Column, now: Column) -> Column:
        last = F.when(before["kind"] == 0, before["place"]).otherwise(26)
        letter = F.element_at(table_, (last * 26 + now["place"] + 1).cast("int"))
        case = F.when(before["kind"] != 0, math.log(0.5)).when(before["capital"] == now["capital"], math.log(SAME_CASE)).otherwise(math.log(1 - SAME_CASE))
        of = F.when(now["kind"] == 0, letter + case).when(now["kind"] == 1, math.log(1 / 10)).otherwise(math.log(1 / 4))
        return F.element_at(follows, before["kind"] * 3 + now["kind"] + 1) + of

    # What stands before a token is like a sign.
    start = F.array(F.struct(F.lit(2).alias("kind"), F.lit(0).alias("place"), F.lit(False).alias("capital")))
    return _sum(F.zip_with(F.concat(start, F.slice(symbols, F.lit(1), F.size(symbols) - 1)), symbols, step))


def scored(tokens: DataFrame, pairs: list[float]) -> DataFrame:
    """``tokens`` (an array column of spans) with the joint p value of the tests, the p value
    under "ordinary", the bits and the class of lengths of each; tokens in no encoding go. The
    tests are written step by step, so that each value is worked out once."""

    def step(df: DataFrame, fn) -> DataFrame:
        return df.withColumn("tokens", F.transform("tokens", fn))

    def keep(t: Column, **more: Column) -> Column:
        return F.struct(t["start"].alias("start"), t["kind"].alias("kind"), t["end"].alias("end"), *[c.alias(n) for n, c in more.items()])

    df = step(tokens, lambda t: keep(t, value=F.rtrim(t["value"], F.lit("="))))
    df = step(df, lambda t: keep(t, value=t["value"], symbols=encoding(t["value"])))
    df = df.withColumn("tokens", F.filter("tokens", lambda t: t["symbols"].isNotNull() & (F.length(t["value"]) >= MIN_TOKEN)))
    df = step(
        df,
        lambda t: keep(
            t,
            n=F.length(t["value"]).cast("double"),
            k=F.length(t["symbols"]).cast("double"),
            codes=F.transform(F.split(t["value"], ""), lambda c: F.position(c, t["symbols"]).cast("double") - 1),
            ordinary=ordinary(t["value"], pairs),
        ),
    )
    df = step(
        df,
        lambda t: keep(
            t,
            n=t["n"],
            k=t["k"],
            codes=t["codes"],
            ordinary=t["ordinary"],
            mean=_sum(t["codes"]) / t["n"],
            low=F.size(F.filter(t["codes"], lambda c: c < t["k"] / 2)).cast("double"),
            runs=1 + _sum(_pairs(t["codes"], lambda a, b: ((a < t["k"] / 2) != (b < t["k"] / 2)).cast("double"))),
            squares=_sum(
                F.transform(
                    F.array_distinct(t["codes"]), lambda c: F.pow(F.size(F.filter(t["codes"], lambda x: x == c)).cast("double"), F.lit(2.0))
                )
            ),
        ),
    )

    def statistics(t: Column) -> Column:
        n, k, mean = t["n"], t["k"], t["mean"]
        chi, spread = t["squares"] * k / n - n, 2 / (9 * (k - 1))
        z_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / (k - 1), F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread)
        expected = 1 + 2 * t["low"] * (n - t["low"]) / n
        variance = (expected - 1) * (expected - 2) / (n - 1)
        z_runs = F.when(variance > 0, F.abs(t["runs"] - expected) / F.sqrt(variance)).otherwise(9.0)
        power = _sum(F.transform(t["codes"], lambda c: (c - mean) * (c - mean)))
        lagged = _sum(_pairs(t["codes"], lambda a, b: (a - mean) * (b - mean)))
        z_serial = F.when(power > 0, F.abs(lagged / power) * F.sqrt(n)).otherwise(9.0)
        # Uniform against ordinary; ordinary tokens reach e^x in one of e^x cases at most.
        p_ordinary = F.exp(F.least(F.lit(0.0), t["ordinary"] + n * F.log(k)))
        return keep(t, n=n, k=k, z_chi=z_chi, z_runs=z_runs, z_serial=z_serial, p_ordinary=p_ordinary)

    df = step(df, statistics)

    def joint(t: Column) -> Column:
        # The fit is not exact in the middle, so that twice the tail can pass 1 by a hair.
        two = lambda z: F.least(F.lit(1.0), 2 * upper_tail(z))
        half = -(F.log(upper_tail(t["z_chi"])) + F.log(two(t["z_runs"])) + F.log(two(t["z_serial"])))
        p = F.exp(-half) * (1 + half + half * half / 2)  # upper tail of chi-squared, six degrees of freedom
        return keep(t, p=p, p_ordinary=t["p_ordinary"], bits=t["n"] * F.log2(t["k"]), stratum=F.floor(F.log2(t["n"])).cast("int"))

    return step(df, joint)


def p_bin(p: Column) -> Column:
    """p values in steps of a twentieth of a decade, 600 at most."""
    return F.least(F.ceil(-20 * F.log10(F.greatest(p, F.lit(1e-30)))), F.lit(600)).cast("int")


def discovery_levels(scores: DataFrame) -> dict[int, int]:
    """Per class of lengths, the least bin that the Benjamini-Hochberg rule takes as discovered.

    The table of counts has a few thousand rows at most, however many candidates there are."""
    flat = scores.select(F.explode("tokens").alias("t")).select(F.col("t.stratum").alias("stratum"), p_bin(F.col("t.p_ordinary")).alias("bin"))
    bins = flat.groupBy("stratum", "bin").agg(F.count("*").alias("tokens"))
    by_p = Window.partitionBy("stratum").orderBy(F.desc("bin"))
    ranked = bins.withColumns(
        {
            "rank": F.sum("tokens").over(by_p.rowsBetween(Window.unboundedPreceding, 0)),
            "all": F.sum("tokens").over(Window.partitionBy("stratum")),
        }
    )
    discovered = F.pow(F.lit(10.0), -(F.col("bin") - 1) / 20.0) <= FALSE_DISCOVERIES * F.col("rank") / F.col("all")
    levels = ranked.where(discovered).groupBy("stratum").agg(F.min("bin").alias("least"))
    return {r["stratum"]: r["least"] for r in levels.collect()}


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans; one row per row of ``docs``.

    The texts are scanned once. What is found in them, not the texts, is stored, because the
    level of discovery needs all candidates before the first can be judged."""
    found = all_spans(docs)
    base = F.concat(*PATTERNS)
    free = F.filter("tokens", lambda t: ~F.exists(base, lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    plain = lambda of: F.transform(of, lambda s: F.struct(s["start"], s["kind"], s["end"]))
    found = found.select("doc_id", *[plain(k).alias(k) for k in PATTERNS], free.alias("tokens"))
    found = store(scored(found, letter_pairs(docs)), "secrets")
    levels = discovery_levels(found)
    never = 601
    level_of = F.create_map(*[F.lit(x) for pair in levels.items() for x in pair]) if levels else None

    def stays(t: Column) -> Column:
        least = F.coalesce(F.element_at(level_of, t["stratum"]), F.lit(never)) if levels else F.lit(never)
        return (t["bits"] >= MIN_BITS) & (t["p"] >= BATTERY_LEVEL) & (p_bin(t["p_ordinary"]) >= least)

    found = found.withColumn("tokens", plain(F.filter("tokens", stays)))
    within = lambda t, s: (s["start"] <= t["start"]) & (t["end"] <= s["end"]) & (t["end"] - t["start"] < s["end"] - s["start"])
    random = F.filter("tokens", lambda t: ~F.exists("tokens", lambda s: within(t, s)))
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in PATTERNS],
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.concat(base, random)).alias("spans"),
        F.size(random).cast("long").alias("n_random"),
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    return find_secrets(table(spark, folder, "documents"))
