"""Secrets: known shapes, and strings that a battery of randomness tests can't tell from random."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asterism.llm.common import bind, id_text, spool
from asterism.llm.spans import find_spans, joined

#: In the order in which spans of one start are listed; the first three are always kept.
KINDS = ["assign", "access", "hex", "random"]
BASE_KINDS = 3

# Possessive and anchored at the start of a run; the plain pattern stands in each comment.
PATTERNS = {
    # (password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+), either case, group 2 of 6+
    "assign": (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
               r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)"""),
    # AKIA[A-Z0-9]+ of 20+
    "access": r"AKIA[A-Z0-9]{16,}+",
    # [0-9a-f]+ of 24+
    "hex": r"(?<![0-9a-f])[0-9a-f]{24,}+",
    "random": r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+",
}
MIN_VALUE = 6

#: Encodings: alphabet in the order of its values, and the strings it is inferred from.
ENCODINGS = {
    "hex": ("0123456789abcdef", r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$"),
    "hex_upper": ("0123456789ABCDEF", r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$"),
    "base32": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+$"),
    "base62": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
               r"^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])[A-Za-z0-9]+$"),
    "base64": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
               r"^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])[A-Za-z0-9+/]+$"),
    "base64url": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
                  r"^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])[A-Za-z0-9_-]+$"),
}

#: The letters in order of their use in texts, most used first.
BY_USE = "etaoinsrhldcumfgpywbvkxjqz"
#: Tried where none of the above fits, on the letters and digits alone. Words fit them too, so their
#: symbols stand in order of use and one more test asks for too many common letters.
PLAIN = {
    "alnum_lower": (BY_USE + "0123456789", r"^(?=.*[0-9])(?=.*[a-z])[0-9a-z]+$"),
    "alnum_upper": (BY_USE.upper() + "0123456789", r"^(?=.*[0-9])(?=.*[A-Z])[0-9A-Z]+$"),
    "lower": (BY_USE, r"^[a-z]+$"),
    "upper": (BY_USE.upper(), r"^[A-Z]+$"),
    "letters": (BY_USE + BY_USE.upper(), r"^[A-Za-z]+$"),
}
#: Digits alone, which are no words.
DIGITS = {"digits": ("0123456789", r"^[0-9]+$")}
#: The least number of letters and digits that are tested without their separators.
MIN_SYMBOLS = 20
#: Parts of a run that are tested besides the whole of it, each of 20+: between slashes, then also
#: between '_', between '-' and between both; and UUIDs.
PARTS = [*[rf"(?<![^{cut}])[^{cut}]{{20,}}+" for cut in ("/", "/_", "/-", "/_-")],
         r"(?<![0-9A-Za-z])[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}(?![0-9A-Za-z])"]

#: Expected share of true random strings among those that the tests dismiss.
FALSE_DISCOVERY = 0.01
#: p-values are ranked in bins of a tenth of a decade, down to 10 ** -30.
BINS_PER_DECADE, BINS = 10, 300
#: The least p-value of one test.
P_FLOOR = 1e-30
#: z of a test that can't be computed as all symbols are alike.
DEGENERATE = 40.0


def upper_tail(z: Column) -> Column:
    """P(N(0, 1) > z): the polynomial of Abramowitz and Stegun 26.2.17, error below 1e-7."""
    t = F.lit(1.0) / (F.abs(z) * 0.2316419 + 1)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)


def _p_value(values: Column, size: Column) -> Column:
    """Fisher's combination of the three tests' p-values: small if the symbols are not random."""
    n = F.size(values).cast("double")
    # what lambdas use is computed once, so that the cost grows with the length and not with its square
    return bind(F.struct((_total(values) / n).alias("mean"), F.transform(values, lambda v: v >= size / 2).alias("high")),
                lambda x: _combined(values, size, n, x["mean"], x["high"]))


def _combined(values: Column, size: Column, n: Column, mean: Column, high: Column) -> Column:
    # chi-squared against equal use of the alphabet; mean and variance of a multinomial sample
    squares = _total(F.transform(F.array_distinct(values), lambda v: F.pow(
        F.size(F.filter(values, lambda x: x == v)).cast("double"), F.lit(2.0))))
    chi = size / n * squares - n
    z_chi = (chi - (size - 1)) / F.sqrt(2 * (size - 1) * (1 - 1 / n))
    # runs above and below the middle of the alphabet
    n1 = _total(F.transform(high, lambda b: b.cast("double")))
    mean_runs = 2 * n1 * (n - n1) / n + 1
    runs = 1 + _total(F.transform(F.sequence(F.lit(1), F.size(values) - 1), lambda i: (
        F.element_at(high, i) != F.element_at(high, i + 1)).cast("double")))
    var_runs = (mean_runs - 1) * (mean_runs - 2) / (n - 1)
    z_runs = F.when(var_runs > 0, (runs - mean_runs) / F.sqrt(var_runs)).otherwise(DEGENERATE)
    # serial correlation at lag 1
    spread = _total(F.transform(values, lambda v: (v - mean) * (v - mean)))
    lagged = _total(F.transform(F.sequence(F.lit(1), F.size(values) - 1), lambda i: (
        (F.element_at(values, i) - mean) * (F.element_at(values, i + 1) - mean))))
    z_serial = F.when(spread > 0, (lagged / spread + 1 / n) * F.sqrt(n)).otherwise(DEGENERATE)

    p = [F.greatest(upper_tail(z_chi), F.lit(P_FLOOR)), F.greatest(2 * upper_tail(F.abs(z_runs)), F.lit(P_FLOOR)),
         F.greatest(2 * upper_tail(F.abs(z_serial)), F.lit(P_FLOOR))]
    x = -sum(F.ln(q) for q in p)  # half of Fisher's statistic, 6 degrees of freedom
    return bind(x, lambda h: F.least(F.exp(-h) * (1 + h + h * h / 2), F.lit(1.0)))


def _p_plain(values: Column, size: Column) -> Column:
    """The battery, or if smaller the chance of symbols as common in texts as these; doubled, as either may dismiss."""
    n = F.size(values).cast("double")
    z = ((size - 1) / 2 - _total(values) / n) * F.sqrt(n * 12 / (size * size - 1))
    return F.least(2 * F.least(_p_value(values, size), F.greatest(upper_tail(z), F.lit(P_FLOOR))), F.lit(1.0))


def randomness(hit: Column, encodings: dict[str, tuple[str, str]] = ENCODINGS,
               p_value: Callable[[Column, Column], Column] = _p_value) -> Column:
    """p-value of the battery under the encoding inferred for a string; null if none fits."""
    alphabet = F.lit(None).cast("string")
    for symbols, shape in reversed(list(encodings.values())):
        alphabet = F.when(hit.rlike(shape), F.lit(symbols)).otherwise(alphabet)

    def tested(a: Column) -> Column:
        values = F.transform(F.split(hit, ""), lambda c: (F.instr(a, c) - 1).cast("double"))
        return F.when(a.isNotNull(), bind(F.struct(values.alias("v"), F.length(a).cast("double").alias("n")),
                                          lambda x: p_value(x["v"], x["n"])))

    return bind(alphabet, tested)


def run_randomness(hit: Column) -> Column:
    """p-value of a whole run or part: as it stands, else of its letters and digits without the separators.

    Null only if these are fewer than ``MIN_SYMBOLS``.
    """
    def alone(symbols: Column) -> Column:
        return F.when(F.length(symbols) >= MIN_SYMBOLS, F.coalesce(
            randomness(symbols, ENCODINGS | DIGITS), randomness(symbols, PLAIN, _p_plain)))

    return F.coalesce(randomness(hit), bind(F.regexp_replace(hit, "[+/_-]", ""), alone))


def _candidates(run: Column) -> Column:
    """(start, kind, end, p) of a run and its parts that can be tested, by start, longer ones first."""
    def placed(s: Column, at: Column) -> Column:
        return F.struct((at + s["start"]).alias("start"), (-at - s["end"]).alias("order"), s["hit"].alias("hit"))

    whole = F.array(F.struct(run["start"].alias("start"), (-run["end"]).alias("order"), run["hit"].alias("hit")))
    parts = F.concat(*[F.transform(find_spans(run["hit"], p), lambda s: placed(s, run["start"])) for p in PARTS])
    strings = F.when(run["hit"].rlike("[/_-]"), F.array_sort(F.array_distinct(F.concat(whole, parts)))).otherwise(whole)
    return F.filter(F.transform(strings, lambda s: F.struct(
        s["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), (-s["order"]).alias("end"),
        run_randomness(s["hit"]).alias("p"))), lambda s: s["p"].isNotNull())


def _outermost(spans: Column) -> Column:
    """The spans of a run that lie in no other; they come by start, longer ones first."""
    ends = F.transform(spans, lambda s: s["end"])
    return F.filter(spans, lambda s, i: (i == 0) | (s["end"] > F.array_max(F.slice(ends, F.lit(1), F.greatest(i, F.lit(1))))))


def _stratum(length: Column) -> Column:
    """Strings of like length (a power of two) are ranked together, as longer ones are tested more sharply."""
    return F.least(F.floor(F.log2(length.cast("double"))).cast("int"), F.lit(16))


def _bin(p: Column) -> Column:
    return F.least(F.floor(-F.log10(p) * BINS_PER_DECADE).cast("int"), F.lit(BINS))


def dismissed_bins(tested: DataFrame) -> dict[int, int]:
    """Benjamini-Hochberg by stratum: the lowest bin of p-values that is dismissed as not random.

    ``tested`` has one row a string with ``stratum`` and ``bin``. Only counts by
    stratum and bin are gathered: at most 17 x 301 rows, whatever the input.
    """
    counts = tested.groupBy("stratum", "bin").agg(F.count(F.lit(1)).alias("n"))
    by = Window.partitionBy("stratum")
    ranked = counts.select(
        "stratum", "bin", F.sum("n").over(by.orderBy(F.col("bin").desc())).alias("rank"), F.sum("n").over(by).alias("m"))
    # the largest p-value that a bin may hold stands for all of it
    fits = F.pow(F.lit(10.0), -F.col("bin") / BINS_PER_DECADE) <= FALSE_DISCOVERY * F.col("rank") / F.col("m")
    return {r["stratum"]: r["least"] for r in
            ranked.where(fits).groupBy("stratum").agg(F.min("bin").alias("least")).collect()}


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``secrets``, the array of (start, kind, end, p) of each whole text.

    Known shapes: assignments to a password-like name, access keys, long hex strings.
    Beyond these, each run of 20 or more characters, and each part of 20 or more between
    its '/', '-' and '_', is tested for randomness in the encoding inferred for it:
    chi-squared for equal use of the alphabet, runs about its middle, serial correlation;
    Fisher's method combines the p-values. Strings that fit no encoding as they stand
    are tested without their separators, if 20 or more letters and digits are left;
    where these may be words (letters, or letters of one case and digits), too many
    of the letters that are common in texts dismiss them as well. Strings are
    dismissed as not random by Benjamini-Hochberg at rate ``FALSE_DISCOVERY`` within
    strata of like length, over all strings of the table; what stays is a span of
    kind ``random``, a part only if no longer string around it stays. ``p`` is null
    for known shapes.

    The candidates of each text are stored once; a second read applies the limits.
    Only counts by stratum and bin are shuffled.

    Defined cases: null and empty texts have no spans; rows that repeat are judged
    alike (and each counts among the strings tested); a null id stays null; an empty
    table gives an empty result; other columns are ignored.
    """
    text = F.col("text")

    def of(kind: str, keep=lambda s: F.lit(True)) -> Column:
        return F.transform(F.filter(find_spans(text, PATTERNS[kind]), keep), lambda s: F.struct(
            s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end"),
            F.lit(None).cast("double").alias("p")))

    long_value = lambda s: F.length(F.regexp_extract(s["hit"], PATTERNS["assign"], 2)) >= MIN_VALUE
    tested = F.filter(F.transform(find_spans(text, PATTERNS["random"]), _candidates), lambda run: F.size(run) > 0)
    found = spool(id_text(docs, id_col, text_col).select(
        "doc_id", F.concat(of("assign", long_value), of("access"), of("hex")).alias("known"), tested.alias("tested")),
        "secret-candidates")

    length = lambda s: s["end"] - s["start"]
    strings = found.select(F.explode(F.flatten("tested")).alias("s")).select(
        _stratum(length(F.col("s"))).alias("stratum"), _bin(F.col("s.p")).alias("bin"))
    least = dismissed_bins(strings)
    limits = F.array(*[F.lit(least.get(i, BINS + 1)) for i in range(17)])
    stays = lambda s: _bin(s["p"]) < F.element_at(limits, _stratum(length(s)) + 1)
    random = F.flatten(F.transform("tested", lambda run: bind(F.filter(run, stays), _outermost)))
    return found.select("doc_id", F.array_sort(F.concat("known", random)).alias("secrets"))


def summary(found: DataFrame) -> DataFrame:
    """Counts, digest and text form of the spans of :func:`find_secrets`."""
    secrets = F.col("secrets")
    count = lambda k: F.size(F.filter(secrets, lambda s: s["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    base = F.filter(secrets, lambda s: s["kind"] < BASE_KINDS)
    return found.select("doc_id", *[count(k) for k in KINDS[:BASE_KINDS]],
                        F.sha2(joined(base, KINDS), 256).alias("base_sha256"), joined(secrets, KINDS).alias("spans"),
                        count("random"))
