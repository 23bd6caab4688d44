"""Secret scans: fixed patterns plus a randomness test battery, in DataFrame operations only.

Base spans are the leftmost non-overlapping matches of three patterns.  Beyond
them, runs of 20 or more encoding characters are candidates.  Each gets the
smallest alphabet that holds it, and three tests against uniform random symbols
of that alphabet: chi-squared uniformity of the symbols, runs above and below the
middle symbol, and lag-one serial correlation.  Fisher's method combines their
p-values; a candidate that fails is not random.

To be reported, a candidate must also be unlike natural tokens, which seldom
change between lower case, upper case and digits: with ``NATURAL_SWITCHES`` as
their rate, the Chernoff bound exp(-(n-1) KL(rate || NATURAL_SWITCHES)) bounds the
chance of so many changes and tightens with length.  Benjamini-Hochberg over the
candidates of all documents controls the share of false reports.  The bound's
logarithm is counted in fixed bins, so the driver sees at most ``BINS`` rows.

Every document stays one row, nothing is shuffled but bin counts.

Defined results: null text is empty; offsets count code points, ends are
exclusive; a null doc_id stays null; repeated rows give repeated results (each
counts in the false-discovery control); empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import keep_table, whole_text

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # runs are maximal, so the length can be asked for at once
HEX = r"[0-9a-f]{24,}"
ASSIGN_VALUE = 6
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"

NATURAL_SWITCHES = 0.1
RANDOM_LEVEL = 0.001
FALSE_DISCOVERIES = 0.01
BINS = 4096
BIN_WIDTH = 0.05  # of -ln p; the last bin holds all beyond

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
# Name, pattern and symbols, from the smallest alphabet to the largest.
ALPHABETS = [
    ("decimal", "^[0-9]+$", DIGITS),
    ("hex", "^[0-9a-f]+$", DIGITS + LOWER[:6]),
    ("hex_upper", "^[0-9A-F]+$", DIGITS + UPPER[:6]),
    ("lower", "^[a-z]+$", LOWER),
    ("upper", "^[A-Z]+$", UPPER),
    ("base32", "^[A-Z2-7]+$", UPPER + DIGITS[2:8]),
    ("lower_digits", "^[a-z0-9]+$", LOWER + DIGITS),
    ("upper_digits", "^[A-Z0-9]+$", UPPER + DIGITS),
    ("letters", "^[A-Za-z]+$", UPPER + LOWER),
    ("alphanumeric", "^[A-Za-z0-9]+$", UPPER + LOWER + DIGITS),
    ("base64", "^[A-Za-z0-9+/]+$", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", "^[A-Za-z0-9_-]+$", UPPER + LOWER + DIGITS + "-_"),
    ("mixed", "^.+$", UPPER + LOWER + DIGITS + "+/-_"),
]

_SPANS = "array<struct<a:int,b:int,probe:string>>"


def _spans(text: Column, pattern: str, probe_group: int = 0) -> Column:
    """(a, b, probe) of each match: code points, and the text of one group.

    The pieces between matches tell where the matches lie.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    probe = found if probe_group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(probe_group))
    steps = F.arrays_zip(
        F.slice(F.split(text, pattern), F.lit(1), F.size(found)).alias("gap"), found.alias("found"), probe.alias("probe")
    )
    walked = F.aggregate(
        steps,
        F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out")),
        lambda acc, s: F.struct(
            (acc["at"] + F.length(s["gap"]) + F.length(s["found"])).alias("at"),
            F.concat(
                acc["out"],
                F.array(
                    F.struct(
                        (acc["at"] + F.length(s["gap"])).alias("a"),
                        (acc["at"] + F.length(s["gap"]) + F.length(s["found"])).alias("b"),
                        s["probe"].alias("probe"),
                    )
                ),
            ).alias("out"),
        ),
    )["out"]
    return F.when(text.rlike(pattern), walked).otherwise(F.array().cast(_SPANS))


def _ends(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["a"].alias("a"), s["b"].alias("b")))


# --- the battery ----------------------------------------------------------------
def _two_sided(z: Column) -> Column:
    """Chance of a normal value at least as far from 0 (error below 2e-7), at least 1e-12."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return F.greatest(poly * F.exp(-x * x), F.lit(1e-12))


def _more(c: Column, names: list[str], **new: Column) -> Column:
    return F.struct(*[c[n].alias(n) for n in names], *[v.alias(k) for k, v in new.items()])


def _count(chars: Column, test) -> Column:
    return F.size(F.filter(chars, test)).cast("double")


def _pairs(values: Column, size: Column) -> Column:
    return F.arrays_zip(F.slice(values, F.lit(1), size - 1).alias("x"), F.slice(values, F.lit(2), size - 1).alias("y"))


def battery(spans: Column) -> Column:
    """For each candidate span: a, b, encoding, p_random (Fisher), surprise (-ln bound)."""
    def chosen(token: Column, at: int) -> Column:
        out = F.when(token.rlike(ALPHABETS[0][1]), F.lit(ALPHABETS[0][at]))
        for row in ALPHABETS[1:]:
            out = out.when(token.rlike(row[1]), F.lit(row[at]))
        return out

    step = F.transform(spans, lambda c: _more(c, ["a", "b", "probe"], encoding=chosen(c["probe"], 0), symbols=chosen(c["probe"], 2)))
    step = F.transform(step, lambda c: _more(c, ["a", "b", "probe", "encoding", "symbols"], chars=F.split(c["probe"], "")))
    step = F.transform(step, lambda c: _more(
        c, ["a", "b", "encoding", "probe"],
        k=F.length(c["symbols"]).cast("double"),
        n=F.length(c["probe"]).cast("double"),
        values=F.transform(c["chars"], lambda x: F.instr(c["symbols"], x).cast("double")),
        classes=F.split(F.regexp_replace(F.regexp_replace(F.regexp_replace(c["probe"], "[a-z]", "l"), "[A-Z]", "u"), "[0-9]", "d"), ""),
        squares=F.aggregate(
            F.array_distinct(c["chars"]), F.lit(0.0),
            lambda acc, x: acc + F.pow((F.length(c["probe"]) - F.length(F.replace(c["probe"], x))).cast("double"), 2.0),
        ),
    ))
    step = F.transform(step, lambda c: _more(
        c, ["a", "b", "encoding", "k", "n", "values", "squares"],
        mean=F.aggregate(c["values"], F.lit(0.0), lambda acc, x: acc + x) / c["n"],
        high=_count(c["values"], lambda x: x > c["k"] / 2),
        runs=1 + _count(_pairs(c["values"], c["n"].cast("int")), lambda p: (p["x"] > c["k"] / 2) != (p["y"] > c["k"] / 2)),
        switches=_count(_pairs(c["classes"], c["n"].cast("int")), lambda p: p["x"] != p["y"]),
    ))
    step = F.transform(step, lambda c: _more(
        c, ["a", "b", "encoding", "k", "n", "squares", "high", "runs", "switches"],
        spread=F.aggregate(c["values"], F.lit(0.0), lambda acc, x: acc + (x - c["mean"]) * (x - c["mean"])),
        shared=F.aggregate(
            _pairs(c["values"], c["n"].cast("int")), F.lit(0.0),
            lambda acc, p: acc + (p["x"] - c["mean"]) * (p["y"] - c["mean"]),
        ),
        mixed=2 * c["high"] * (c["n"] - c["high"]),
    ))
    step = F.transform(step, lambda c: _more(
        c, ["a", "b", "encoding", "n", "switches"],
        chi=((c["k"] / c["n"] * c["squares"] - c["n"]) - (c["k"] - 1)) / F.sqrt(2 * (c["k"] - 1) * (1 - 1 / c["n"])),
        run=F.when(
            c["mixed"] > c["n"],
            (c["runs"] - 1 - c["mixed"] / c["n"])
            / F.sqrt(c["mixed"] * (c["mixed"] - c["n"]) / (c["n"] * c["n"] * (c["n"] - 1))),
        ).otherwise(F.sqrt(c["n"])),
        serial=F.when(c["spread"] > 0, (c["shared"] / c["spread"] + 1 / c["n"]) * F.sqrt(c["n"])).otherwise(F.sqrt(c["n"])),
        rate=c["switches"] / (c["n"] - 1),
    ))
    step = F.transform(step, lambda c: _more(
        c, ["a", "b", "encoding"],
        fisher=-F.log(_two_sided(c["chi"])) - F.log(_two_sided(c["run"])) - F.log(_two_sided(c["serial"])),
        surprise=F.when(
            c["rate"] > NATURAL_SWITCHES,
            (c["n"] - 1) * (
                c["rate"] * F.log(c["rate"] / NATURAL_SWITCHES)
                + F.when(c["rate"] < 1, (1 - c["rate"]) * F.log((1 - c["rate"]) / (1 - NATURAL_SWITCHES))).otherwise(0.0)
            ),
        ).otherwise(0.0),
    ))
    # three independent tests: half the Fisher statistic x has the survival e^-x (1 + x + x^2 / 2)
    return F.transform(step, lambda c: _more(
        c, ["a", "b", "encoding", "surprise"],
        p_random=F.exp(-c["fisher"]) * (1 + c["fisher"] + c["fisher"] * c["fisher"] / 2),
    ))


def _bin(surprise: Column) -> Column:
    return F.least(F.floor(surprise / BIN_WIDTH), F.lit(BINS - 1)).cast("int")


def least_surprise_bin(scanned: DataFrame) -> int:
    """Benjamini-Hochberg: the first bin whose candidates may all be reported.

    A bin stands for its weakest bound exp(-bin * width).  With ``up`` candidates at
    least as surprising, of ``m``, that bound must be at most up / m of the rate.
    """
    bins = scanned.select(F.explode("candidates").alias("c")).groupBy(_bin(F.col("c.surprise")).alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    up = F.sum("n").over(Window.orderBy(F.desc("bin")))  # at most BINS rows
    m = F.sum("n").over(Window.partitionBy())
    allowed = F.exp(-F.col("bin") * BIN_WIDTH) <= F.lit(FALSE_DISCOVERIES) * F.col("up") / F.col("m")
    row = bins.select("bin", up.alias("up"), m.alias("m")).where(allowed).agg(F.min("bin").alias("bin")).first()
    return BINS if row.bin is None else row.bin


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: counts, base_sha256, spans (text), and ``found``: kind, a, b of every span."""
    text = F.col("text")
    rows = docs.select(docs[id_col].cast("bigint").alias("doc_id"), whole_text(docs, text_col).alias("text"))
    scanned = keep_table(
        rows.select(
            "doc_id",
            _ends(F.filter(_spans(text, ASSIGN, 2), lambda s: F.length(s["probe"]) >= ASSIGN_VALUE)).alias("assign"),
            _ends(_spans(text, ACCESS)).alias("access"),
            _ends(_spans(text, HEX)).alias("hex"),
            battery(_spans(text, CANDIDATE)).alias("candidates"),
        ),
        "secret-spans",
    )
    least = least_surprise_bin(scanned)

    def listed(kind: str, order: int) -> Column:
        return F.transform(kind, lambda s: F.struct(s["a"].alias("a"), F.lit(order).alias("order"), s["b"].alias("b"), F.lit(kind).alias("kind")))

    based = scanned.withColumn("base", F.array_sort(F.concat(listed("assign", 0), listed("access", 1), listed("hex", 2))))
    free = lambda c: ~F.exists("base", lambda s: (s["a"] < c["b"]) & (c["a"] < s["b"]))
    random = F.filter(
        "candidates",
        lambda c: (_bin(c["surprise"]) >= least) & (c["p_random"] >= RANDOM_LEVEL) & (c["encoding"] != "decimal") & free(c),
    )
    all_spans = based.withColumn("random", random).withColumn(
        "found", F.array_sort(F.concat(F.col("base"), listed("random", 3)))
    )

    def text_of(spans: str) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["a"].cast("string"), s["b"].cast("string"))), ","
        )

    return all_spans.select(
        "doc_id",
        *[F.size(k).cast("bigint").alias(f"n_{k}") for k in ("assign", "access", "hex", "random")],
        F.sha2(text_of("base"), 256).alias("base_sha256"),
        text_of("found").alias("spans"),
        F.transform("found", lambda s: F.struct(s["kind"].alias("kind"), s["a"].alias("start"), s["b"].alias("end"))).alias("found"),
    )
