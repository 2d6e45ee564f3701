"""Secret scan: rule matches plus a randomness test battery, all in SQL functions.

Rule matches (kinds ``assign``, ``access``, ``hex``) are the leftmost
non-overlapping matches of three patterns.  The battery looks at every maximal
run of at least twenty of ``[A-Za-z0-9+/_-]``, with padding.  Each run gets
the smallest encoding that holds it (decimal, hex, base32, alphanumeric,
base64), its characters become symbol values, and three statistics are taken:

* chi-squared of the symbols against a uniform alphabet, in eight equal cells;
* runs above and below the middle of the alphabet (Wald-Wolfowitz);
* lag-one serial correlation.

Ordinary text fails such tests and random keys pass, so the null hypothesis
turned round is "structured by at least a given margin": the p-value of each
test is the chance that text with that margin looks this random.  The margin
shift grows with the root of the length, so short runs can't give small
p-values.  All three must reject (the greatest p-value counts), and the
Benjamini-Hochberg rule over all runs of one encoding and one length class (a
factor of two) keeps the expected share of false discoveries under ``fdr``.
The rule needs the ranks of all p-values: they are counted in cells of a
hundredth of a power of ten, so what is ranked is one row per cell.

Edge cases: null text counts as empty and has no match; repeated rows are
scanned each for themselves; spans are code points, end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import unused

# FIXED VALUES: the patterns of the rule kinds, in the order in which kinds are listed.
ASSIGN = r"""(?i:(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = r"""^(?i:(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)$"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
RUN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
KINDS = {"assign": 0, "access": 1, "hex": 2, "random": 3}

# Alphabets in value order; a run's encoding is the first that holds it.
ALPHABETS = {
    "decimal": ("^[0-9]+$", "0123456789"),
    "hex": ("^([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef"),
    "base32": ("^[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    "alnum": ("^[A-Za-z0-9]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    "base64": ("^.*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
}
CELLS = 8


def matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, value) of all matches: the text between matches
    and the matches themselves alternate, so positions are sums of lengths."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    steps = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, m: F.struct(g.alias("g"), m.alias("m")))
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    state = F.struct(F.lit(0).alias("at"), empty.alias("spans"))

    def add(s: Column, x: Column) -> Column:
        start = s["at"] + x["g"]
        end = start + F.length(x["m"])
        span = F.struct(start.alias("start"), end.alias("end"), x["m"].alias("value"))
        return F.struct(end.alias("at"), F.array_append(s["spans"], span).alias("spans"))

    return F.when(F.size(found) > 0, F.aggregate(steps, state, add, lambda s: s["spans"])).otherwise(empty)


def _normal_tail(z: Column) -> Column:
    """P(N(0,1) > z), Abramowitz and Stegun 26.2.17."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-a * a / 2) * 0.3989422804014327 * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _encoding(value: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, (pattern, _) in reversed(ALPHABETS.items()):
        out = F.when(value.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def _symbols(value: Column, encoding: Column) -> Column:
    """Symbol values scaled into (0, 1); padding goes, URL-safe letters count as
    their base64 twins, hex digits in either case alike."""
    plain = F.translate(F.regexp_replace(value, "=+$", ""), "-_", "+/")
    out = F.lit(None).cast("array<double>")
    for name, (_, letters) in ALPHABETS.items():
        chars = F.split(F.lower(plain) if name == "hex" else plain, "")
        scaled = F.transform(F.filter(chars, lambda c: c != ""), lambda c: (F.position(c, F.lit(letters)) - 0.5) / len(letters))
        out = F.when(encoding == name, scaled).otherwise(out)
    return out


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v)


def battery(runs: Column, chi_margin: float = 1.0, runs_margin: float = 0.5, corr_margin: float = 0.6) -> Column:
    """Array of (start, end, value) -> array of (start, end, encoding, size, p).

    The margins are the least structure under the null: chi-squared per symbol,
    the share of runs that is missing, and the size of the correlation."""
    coded = F.transform(runs, lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), r["value"].alias("value"),
                                                 _encoding(r["value"]).alias("encoding")))
    coded = F.transform(coded, lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), r["encoding"].alias("encoding"),
                                                  F.length(r["value"]).alias("size"),
                                                  _symbols(r["value"], r["encoding"]).alias("x")))

    def tests(r: Column) -> Column:
        x = r["x"]
        n = F.size(x).cast("double")
        counts = F.transform(F.sequence(F.lit(0), F.lit(CELLS - 1)), lambda c: F.size(F.filter(x, lambda v: F.floor(v * CELLS) == c)))
        before, after = F.slice(x, 1, F.greatest(F.size(x) - 1, F.lit(0))), F.slice(x, 2, F.greatest(F.size(x) - 1, F.lit(0)))
        return F.struct(
            r["start"].alias("start"), r["end"].alias("end"), r["encoding"].alias("encoding"), r["size"].alias("size"),
            n.alias("n"), _sum(F.transform(counts, lambda k: F.pow(k - n / CELLS, F.lit(2)) * CELLS / n)).alias("chi"),
            _sum(F.transform(x, lambda v: F.when(v >= 0.5, 1.0).otherwise(0.0))).alias("high"),
            (1 + _sum(F.zip_with(before, after, lambda a, b: F.when((a >= 0.5) != (b >= 0.5), 1.0).otherwise(0.0)))).alias("runs"),
            (_sum(x) / n).alias("mean"), _sum(F.zip_with(before, after, lambda a, b: a * b)).alias("cross"),
            _sum(F.transform(x, lambda v: v * v)).alias("square"),
            F.element_at(x, 1).alias("first"), F.element_at(x, -1).alias("last"))

    def combine(r: Column) -> Column:
        n, high = r["n"], r["high"]
        low, m = n - high, r["mean"]
        df = float(CELLS - 1)
        p_chi = 1 - _normal_tail((r["chi"] - (df + chi_margin * n)) / F.sqrt(2 * df + 4 * chi_margin * n))
        pairs = 2 * high * low
        spread = F.sqrt(F.greatest(pairs * (pairs - n) / (n * n * F.greatest(n - 1, F.lit(1.0))), F.lit(0.25)))
        p_runs = F.when((high < 1) | (low < 1), F.lit(1.0)).otherwise(
            _normal_tail((r["runs"] - (1 - runs_margin) * (pairs / n + 1)) / spread))
        var = r["square"] - n * m * m
        cov = r["cross"] - m * (2 * n * m - r["first"] - r["last"]) + (n - 1) * m * m
        corr = F.when(var > 1e-9, F.least(F.abs(cov / var), F.lit(0.999))).otherwise(0.999)
        p_corr = _normal_tail((F.atanh(F.lit(corr_margin)) - F.atanh(corr)) * F.sqrt(F.greatest(n - 3, F.lit(1.0))))
        return F.struct(r["start"].alias("start"), r["end"].alias("end"), r["encoding"].alias("encoding"), r["size"].alias("size"),
                        F.greatest(p_chi, p_runs, p_corr, F.lit(1e-12)).alias("p"))

    tested = F.filter(F.transform(coded, tests), lambda r: r["n"] >= 1)
    return F.transform(tested, combine)


def _class(size: Column) -> Column:
    return F.floor(F.log2(size)).cast("int")


def _cell(p: Column) -> Column:
    return F.ceil(F.log10(p) * 100).cast("int")


def fdr_cuts(docs: DataFrame, fdr: float = 0.05) -> dict[tuple[str, int], int]:
    """The discovery rule's cut per (encoding, length class): five encodings by
    thirty classes at most reach the driver.  The cut is the greatest cell whose
    upper edge is at most ``fdr`` times the share of runs up to it."""
    runs = docs.select(F.explode(battery(matches(F.coalesce("text", F.lit("")), RUN))).alias("r"))
    cells = runs.groupBy("r.encoding", _class(F.col("r.size")).alias("size"), _cell(F.col("r.p")).alias("cell")).agg(F.count("*").alias("n"))
    part = Window.partitionBy("encoding", "size")
    ranked = cells.withColumn("upto", F.sum("n").over(part.orderBy("cell"))).withColumn("all", F.sum("n").over(part))
    passed = ranked.where(F.pow(F.lit(10.0), F.col("cell") / 100.0) <= fdr * F.col("upto") / F.col("all"))
    return {(r["encoding"], r["size"]): r["cut"] for r in passed.groupBy("encoding", "size").agg(F.max("cell").alias("cut")).collect()}


def spans_column(text: Column, cuts: dict[tuple[str, int], int]) -> Column:
    """Array of (start, rank, end): all spans by start, then kind; ``rank`` is
    the kind's place in ``KINDS``."""
    def as_spans(found: Column, kind: str) -> Column:
        return F.transform(found, lambda r: F.struct(r["start"].alias("start"), F.lit(KINDS[kind]).alias("rank"), r["end"].alias("end")))

    assign = F.filter(matches(text, ASSIGN), lambda r: F.length(F.regexp_extract(r["value"], ASSIGN_VALUE, 1)) >= 12)

    def found(r: Column) -> Column:
        cut = F.lit(-10000)
        for (encoding, size), c in sorted(cuts.items()):
            cut = F.when((r["encoding"] == encoding) & (_class(r["size"]) == size), F.lit(c)).otherwise(cut)
        return _cell(r["p"]) <= cut

    random = F.filter(battery(matches(text, RUN)), found) if cuts else F.filter(battery(matches(text, RUN)), lambda r: F.lit(False))
    return F.array_sort(F.concat(as_spans(assign, "assign"), as_spans(matches(text, ACCESS), "access"),
                                 as_spans(matches(text, HEX), "hex"), as_spans(random, "random")))


def scan(docs: DataFrame, out: str = "spans", fdr: float = 0.05) -> DataFrame:
    """``docs`` with its spans in ``out`` (a column of that name is replaced)."""
    return docs.withColumn(out, spans_column(F.coalesce("text", F.lit("")), fdr_cuts(docs, fdr)))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    kind = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda r: F.concat_ws(":", F.element_at(kind, r["rank"] + 1), r["start"], r["end"])), ",")


def redact(docs: DataFrame, fdr: float = 0.05, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every stretch covered by spans replaced by ``mark`` and
    ``n_chars``, where present, counted anew; null text stays null."""
    text = F.col("text")
    spans, = unused(docs, "__spans")
    found = scan(docs, spans, fdr)
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(s: Column, r: Column) -> Column:
        fresh = r["start"] >= s["at"]
        cut = F.concat(s["out"], F.substring(text, s["at"] + 1, r["start"] - s["at"]), F.lit(mark))
        first = (s["at"] == 0) & (s["out"] == "")
        return F.struct(F.greatest(s["at"], r["end"]).alias("at"), F.when(fresh | first, cut).otherwise(s["out"]).alias("out"))

    clean = F.aggregate(spans, state, add, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    clean = F.when(F.size(spans) > 0, clean).otherwise(text)
    done = found.withColumn("text", clean).drop(spans)
    return done.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else done
