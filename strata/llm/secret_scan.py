"""Secret scan: fixed patterns plus a randomness test battery.

Patterns (kinds ``assign``, ``access``, ``hex``) are leftmost and
non-overlapping per kind.  Offsets come from the pieces between matches: the
k-th match starts after the first k pieces and the matches between them.

The battery looks at every run of 20 or more characters of
``[A-Za-z0-9+/_-]``, with the ``=`` that pad its end, that overlaps no pattern
span; in ``name=value`` both sides are runs of their own.  Per run:

* the encoding is inferred from the characters: ``hex`` (k = 16), ``base32``
  (k = 32), ``base64`` (k = 64; at least two of upper case, lower case, digit);
  other runs (digits only, one case of letters only) have no encoding and are
  plain words or numbers;
* against the hypothesis of random symbols: a chi-squared statistic for a
  uniform alphabet, a runs test around the middle of the alphabet and a
  serial-correlation test of neighbouring symbols.  The three p-values are
  joined by Fisher's method; a run with a joint p-value below ``alpha`` has
  structure and is no secret;
* against the hypothesis of language: repeated symbols are much more frequent
  in text than in a random string.  The p-value is the chance that a text of
  this length, whose symbols coincide with probability ``text_coincidence``,
  has as few coinciding pairs as seen.  Short runs have little evidence and get
  large p-values.

Runs that pass the battery are reported where the second p-value survives the
Benjamini-Hochberg procedure at rate ``fdr`` within its (encoding, length band)
family, so many short words cannot crowd out or let in long ones.  The
procedure works on a histogram of -log2(p) (rounded down: conservative), whose
size does not depend on the data; no global sort is needed.

Defined cases: a NULL text is scanned as an empty one (no spans) and stays NULL
when redacted; repeated rows count as often as they occur; a text of any length
is scanned whole; an empty table gives an empty result; further columns, also
of clashing names, are passed through by ``redact`` and ignored by the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import let, materialise

# The patterns; group 2 of an assignment has 12 characters or more.
ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"            # the runs of [0-9a-f]+ that are long enough
MIN_ASSIGN, MIN_ACCESS = 12, 18
KINDS = ("assign", "access", "hex", "random")
BLOCK = 256                      # matches numbered at a time
RUN = r"[A-Za-z0-9+/_-]{20,}(?:=++(?![A-Za-z0-9+/_-]))?"    # "=" only as padding at the end

ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
# Chance that two symbols of ordinary text in this alphabet are equal.
TEXT_COINCIDENCE = {"hex": 0.16, "base32": 0.075, "base64": 0.06}
ALPHA, FDR = 0.01, 0.05
LENGTH_BANDS = (24, 32, 48, 64, 128)
HISTOGRAM_BINS = 512


_SPANS = "array<struct<s:int,e:int,m:string>>"


def match_spans(text: Column, pattern: str) -> Column:
    """array<struct(s, e, m)> of the leftmost, non-overlapping matches: code
    point offsets (end exclusive) and the matched text."""
    whole = f"(?i)({pattern[4:]})" if pattern.startswith("(?i)") else f"({pattern})"

    def number(pairs: Column) -> Column:
        # in blocks, so that texts with very many matches stay near linear
        last = F.floor((F.size(pairs) - 1) / BLOCK).cast("int")
        return let(F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(pairs, b * BLOCK + 1, F.lit(BLOCK))), place)

    def place(blocks: Column) -> Column:
        sizes = F.transform(blocks, lambda block: F.aggregate(
            block, F.lit(0), lambda a, x: a + F.length(x["p"]) + F.length(x["m"])))

        def within(sizes: Column, block: Column, i: Column) -> Column:
            base = F.aggregate(F.slice(sizes, F.lit(1), i), F.lit(0), lambda a, x: a + x)
            start = F.struct(base.alias("at"), F.array().cast(_SPANS).alias("out"))
            return F.aggregate(block, start, step, lambda acc: acc["out"])

        return let(sizes, lambda sizes: F.flatten(F.transform(blocks, lambda block, i: within(sizes, block, i))))

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + F.length(x["p"])
        e = s + F.length(x["m"])
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(
            F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m")))).alias("out"))

    pairs = let(F.regexp_extract_all(text, F.lit(whole), F.lit(1)), lambda m: F.arrays_zip(
        F.slice(F.split(text, pattern, -1), F.lit(1), F.size(m)).alias("p"), m.alias("m")))
    # most texts match nothing: one search decides before any array is built
    return F.when(text.rlike(pattern), let(pairs, number)).otherwise(F.array().cast(_SPANS))


def _kind(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(KINDS.index(kind)).alias("k")))


def _overlaps(spans: Column, x: Column) -> Column:
    return F.exists(spans, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))


# -- the battery -------------------------------------------------------------

def _normal_tail(z: Column) -> Column:
    """P(Z > z) for z >= 0 (Abramowitz and Stegun 26.2.17, error below 1e-7)."""
    t = 1 / (1 + F.lit(0.2316419) * z)
    series = t * (F.lit(0.319381530) + t * (F.lit(-0.356563782) + t * (F.lit(1.781477937) + t * (F.lit(-1.821255978) + t * F.lit(1.330274429)))))
    return F.greatest(F.exp(-z * z / 2) * F.lit(0.3989422804014327) * series, F.lit(1e-300))


def _two_sided(z: Column) -> Column:
    return F.least(F.lit(1.0), 2 * _normal_tail(F.abs(z)))


def encoding_of(run: Column) -> Column:
    """Name of the inferred encoding, NULL for none."""
    body = F.regexp_replace(run, "=+$", "")
    kinds = sum((run.rlike(p).cast("int") for p in ("[a-z]", "[A-Z]", "[0-9]")), F.lit(0))
    return (F.when(body.rlike("[0-9]") & body.rlike("[a-fA-F]") & (body.rlike("^[0-9a-f]+$") | body.rlike("^[0-9A-F]+$")), "hex")
            .when(body.rlike("[2-7]") & body.rlike("^[A-Z2-7]+$"), "base32")
            .when((kinds >= 2) & body.rlike("[0-9]|[a-z][A-Z]") & body.rlike("^[A-Za-z0-9+/_-]+$"), "base64"))


def _statistics(body: Column, encoding: str) -> Column:
    """struct(n, p_random, bits): the battery of one run in one encoding."""
    symbols = ALPHABETS[encoding]
    k, kappa = float(len(symbols)), TEXT_COINCIDENCE[encoding]
    text = F.lower(body) if encoding == "hex" else body if encoding == "base32" else F.translate(body, "-_", "+/")

    def p_uniform(squares: Column, n: Column) -> Column:
        # chi-squared by Wilson and Hilferty's cube root
        df, spread = k - 1, 2 / (9 * (k - 1))
        chi = F.greatest(squares * k / n - n, F.lit(0.0))
        return let((F.pow(chi / df, F.lit(1 / 3)) - (1 - spread)) / (spread ** 0.5),
                   lambda z: F.when(z > 0, _normal_tail(z)).otherwise(1 - _normal_tail(-z)))

    def p_runs(pairs: Column, n: Column) -> Column:
        turns = F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + ((x["a"] >= k / 2) != (x["b"] >= k / 2)).cast("double"))
        return let((turns - (n - 1) / 2) / F.sqrt((n - 1) / 4), _two_sided)

    def p_serial(pairs: Column, n: Column) -> Column:
        mean, var = (k - 1) / 2, (k * k - 1) / 12
        product = F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + (x["a"] - mean) * (x["b"] - mean))
        return let(product / (var * F.sqrt(n - 1)), _two_sided)

    def p_text(squares: Column, n: Column) -> Column:
        # coinciding pairs of language, about normal with the variance of a mixed Poisson count
        expected = n * (n - 1) / 2 * kappa
        return let((expected - (squares - n) / 2) / F.sqrt(expected * (1 + n * kappa / 2)),
                   lambda z: F.when(z > 0, _normal_tail(z)).otherwise(F.lit(0.5)))

    def join(squares: Column, pairs: Column, n: Column) -> Column:
        tests = [p_uniform(squares, n), p_runs(pairs, n), p_serial(pairs, n)]
        half = -sum((F.log(F.greatest(p, F.lit(1e-300))) for p in tests), F.lit(0.0))      # Fisher
        return F.struct(n.cast("int").alias("n"),
                        let(half, lambda h: F.exp(-h) * (1 + h + h * h / 2)).alias("p_random"),
                        (-F.log2(p_text(squares, n))).alias("bits"))

    def run(text: Column) -> Column:
        n = F.length(text).cast("double")
        counts = F.transform(F.array(*[F.lit(c) for c in symbols]), lambda c: n - F.length(F.replace(text, c, F.lit(""))))
        squares = F.aggregate(counts, F.lit(0.0), lambda a, c: a + c * c)
        order = F.transform(F.split(text, ""), lambda c: F.call_function("instr", F.lit(symbols), c).cast("double") - 1)
        pairs = let(order, lambda o: F.zip_with(F.slice(o, F.lit(1), F.size(o) - 1), F.slice(o, F.lit(2), F.size(o) - 1),
                                                lambda a, b: F.struct(a.alias("a"), b.alias("b"))))
        return let(F.struct(squares.alias("q"), pairs.alias("p"), n.alias("n")), lambda v: join(v["q"], v["p"], v["n"]))

    return let(text, run)


def battery(run: Column) -> Column:
    """struct(enc, n, p_random, bits) of a run; enc is NULL without an encoding."""
    body = F.regexp_replace(run, "=+$", "")
    enc = encoding_of(run)

    def test(enc: Column) -> Column:
        stats = None
        for name in ALPHABETS:
            value = _statistics(body, name)
            stats = F.when(enc == name, value) if stats is None else stats.when(enc == name, value)
        return let(stats, lambda t: F.struct(enc.alias("enc"), t["n"].alias("n"), t["p_random"].alias("p_random"),
                                             t["bits"].alias("bits")))

    return let(enc, test)


def _band(n: Column) -> Column:
    out = F.lit(len(LENGTH_BANDS))
    for i, top in reversed(list(enumerate(LENGTH_BANDS))):
        out = F.when(n < top, i).otherwise(out)
    return out


def _spans(text: Column) -> dict[str, Column]:
    assign = F.filter(match_spans(text, ASSIGN), lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 2)) >= MIN_ASSIGN)
    access = F.filter(match_spans(text, ACCESS), lambda x: x["e"] - x["s"] >= MIN_ACCESS)
    return {"assign": assign, "access": access, "hex": match_spans(text, HEX)}


def with_spans(docs: DataFrame, text_col: str, keep: list[str], alpha: float = ALPHA, fdr: float = FDR) -> DataFrame:
    """``keep`` columns plus ``__base`` and ``__spans``: array<struct(s, e, k)>,
    sorted.  The rows with spans still to be judged are written once, so that
    texts are scanned a single time."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.select(*keep, text.alias("__text"))
    df = df.withColumns({f"__{k}": v for k, v in _spans(F.col("__text")).items()})
    df = df.withColumn("__base", F.array_sort(F.concat(*[_kind(F.col(f"__{k}"), k) for k in ("assign", "access", "hex")])))
    runs = let(F.col("__base"), lambda base: F.filter(match_spans(F.col("__text"), RUN), lambda x: ~_overlaps(base, x)))
    judged = F.transform(runs, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), battery(x["m"]).alias("t")))
    judged = F.filter(judged, lambda x: x["t"]["enc"].isNotNull())
    judged = F.transform(judged, lambda x: F.struct(
        x["s"].alias("s"), x["e"].alias("e"), x["t"]["enc"].alias("enc"), _band(x["t"]["n"]).alias("band"),
        F.least(F.floor(x["t"]["bits"]), F.lit(HISTOGRAM_BINS - 1)).cast("int").alias("bin"),
        (x["t"]["p_random"] >= alpha).alias("random")))
    held = materialise(df.select(*keep, "__base", judged.alias("__judged")), "secret-spans")

    # Benjamini-Hochberg per family on the histogram: at most families * bins rows
    bins = (held.select(F.explode("__judged").alias("j")).groupBy("j.enc", "j.band", "j.bin")
            .agg(F.count(F.lit(1)).alias("n")))
    family = Window.partitionBy("enc", "band")
    above = family.orderBy(F.desc("bin"))
    limits = (bins.withColumn("rank", F.sum("n").over(above)).withColumn("m", F.sum("n").over(family))
              .where(F.pow(F.lit(2.0), -F.col("bin")) <= F.col("rank") * F.lit(fdr) / F.col("m"))
              .groupBy("enc", "band").agg(F.min("bin").alias("least")))
    # at most len(ALPHABETS) * (len(LENGTH_BANDS) + 1) rows
    least = {f"{r['enc']}/{r['band']}": r["least"] for r in limits.collect()}
    if not least:
        return held.select(*keep, "__base", F.col("__base").alias("__spans"))
    table = F.create_map(*[F.lit(x) for item in sorted(least.items()) for x in item])
    found = F.filter("__judged", lambda j: j["random"] & (
        j["bin"] >= F.coalesce(F.try_element_at(table, F.concat_ws("/", j["enc"], j["band"].cast("string"))),
                               F.lit(HISTOGRAM_BINS))))
    return held.select(*keep, "__base", F.array_sort(F.concat("__base", _kind(found, "random"))).alias("__spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alpha: float = ALPHA,
                 fdr: float = FDR) -> DataFrame:
    """One row per document: counts per kind and all spans."""
    df = with_spans(docs, text_col, [id_col], alpha, fdr)

    def count(kind: str) -> Column:
        k = KINDS.index(kind)
        return F.size(F.filter("__spans", lambda x: x["k"] == k)).cast("long")

    return df.select(id_col, *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
                     F.sha2(span_text(F.col("__base")).cast("binary"), 256).alias("base_sha256"),
                     span_text(F.col("__spans")).alias("spans"), count("random").alias("n_random"))


def cut_out(text: Column, spans: Column, mark: str) -> Column:
    """``text`` with every span (overlapping ones as one) replaced by ``mark``."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        piece = F.concat(F.substring(text, acc["at"] + 1, x["s"] - acc["at"]), F.lit(mark))
        out = F.when(x["s"] >= acc["at"], F.concat(acc["out"], F.array(piece))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), out.alias("out"))

    done = F.aggregate(spans, start, step)
    return F.concat(F.array_join(done["out"], ""), F.substring(text, done["at"] + 1, F.length(text)))


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", mark: str = "[SECRET]",
           alpha: float = ALPHA, fdr: float = FDR) -> DataFrame:
    """All rows and columns of ``docs``, whatever they are called; secrets in the
    text are replaced."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    df = with_spans(packed, "text", ["row"], alpha, fdr)
    dirty, text = F.size("__spans") > 0, F.col("row")[text_col]
    out = {c: F.col("row")[c] for c in docs.columns}
    out[text_col] = F.when(dirty, cut_out(text, F.col("__spans"), mark)).otherwise(text)
    if length_col in docs.columns:
        size = F.length(out[text_col]).cast(docs.schema[length_col].dataType)
        out[length_col] = F.when(dirty, size).otherwise(out[length_col])
    return df.select(*[c.alias(name) for name, c in out.items()])
