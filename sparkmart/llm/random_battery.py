"""Secret scan: fixed patterns, and a battery of randomness tests.

Three fixed patterns give the base spans.  Besides, every long token in an
encoding's alphabet is a candidate for the battery:

* chi-squared uniformity over the alphabet of the inferred encoding, the runs
  test about the alphabet's middle, and the serial correlation of neighbours,
  each as a two-sided p-value under "drawn uniformly", joined by Fisher's rule;
* under "ordinary text", where a symbol pair agrees with probability
  ``TEXT_INDEX``, chi-squared rises with the length; the lower tail of that
  law is the token's p-value as a discovery.

A token is reported when its discovery passes Benjamini-Hochberg at ``FDR``
among the tokens of its length band (powers of two: short tokens have less
power and do not borrow from long ones), and uniformity is not rejected at
``KEEP``.  The step-up rule needs only counts of p-values on a fixed grid per
band, so it is one small aggregate, whatever the number of tokens.

All of it is DataFrame and SQL functions.  Positions come from splitting a
text at its marked matches and summing piece lengths per document.

Defined cases: a null or empty text has no spans and the hash of the empty
string; offsets are code points; U+0001 in a text counts as one character; a
very long text or token is tested whole, in time linear in its length;
rows with null or repeated keys are reported row by row; spans that start together
stand in the order of kinds; digits alone are never a candidate; ``redact`` drops the
noncharacters U+FDD0 and U+FDD1 from texts that hold an assignment, and works beside
columns of any name; an empty table gives an empty result; ``scan`` reads no other columns.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import table

# fixed values: kinds in the order of ties, and their patterns
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"   # a shorter run of the class cannot hold a longer one
HEX = r"[0-9a-f]{24,}+"
ASSIGN_LEAST = 6

#: our parameters: candidate tokens, text's symbol agreement, levels, grid of -ln p
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"
TEXT_INDEX = 0.06
FDR = 0.01
KEEP = 0.001
GRID, GRID_END = 4, 400

_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: (test, alphabet), the narrowest first; digits alone are no encoding
ENCODINGS = (
    ("^[0-9]+$", None),
    ("^[0-9a-f]+$", _DIGITS + "abcdef"),
    ("^[0-9A-F]+$", _DIGITS + "ABCDEF"),
    ("^[a-z]+$", _LOWER),
    ("^[A-Z]+$", _UPPER),
    ("^[A-Z2-7]+$", _UPPER + "234567"),
    ("^[0-9a-z]+$", _DIGITS + _LOWER),
    ("^[0-9A-Z]+$", _DIGITS + _UPPER),
    ("^[A-Za-z]+$", _UPPER + _LOWER),
    ("^[0-9A-Za-z]+$", _DIGITS + _UPPER + _LOWER),
    ("^[0-9A-Za-z+/]+$", _UPPER + _LOWER + _DIGITS + "+/"),
    ("^[0-9A-Za-z_-]+$", _UPPER + _LOWER + _DIGITS + "-_"),
)


def _upper_tail(z: str) -> str:
    """P(Z > z) of a standard normal, by the logistic approximation."""
    return f"(1 / (1 + exp(least(700D, 1.5976D * {z} + 0.07056D * {z} * {z} * {z}))))"


def _steps() -> list[dict[str, str]]:
    """The battery as layers of SQL over a token's earlier fields (``e``)."""
    letters = "CASE " + " ".join(f"WHEN e.s RLIKE '{test}' THEN {'NULL' if a is None else repr(a)}"
                                 for test, a in ENCODINGS) + " END"
    pair = "zip_with(slice(e.x, 1, size(e.x) - 1), slice(e.x, 2, size(e.x) - 1), (x, y) -> {})"
    tails = " - ".join(["0D", *(f"ln(greatest(1e-12D, 2 * {_upper_tail(z)}))" for z in ("e.z1", "e.z2", "e.z3"))])
    return [
        {"a": letters, "n": "double(length(e.s))"},
        {"k": "double(length(e.a))",
         "x": "CASE WHEN e.a IS NOT NULL THEN transform(slice(split(e.s, ''), 1, length(e.s)), "
              "c -> double(instr(e.a, c) - 1)) END"},
        {"sq": "aggregate(slice(split(e.a, ''), 1, length(e.a)), 0D, (t, c) -> t "
               "+ pow(length(e.s) - length(replace(e.s, c, '')), 2))",
         "hi": "aggregate(e.x, 0D, (t, x) -> t + IF(x >= e.k / 2, 1D, 0D))",
         "r": f"aggregate({pair.format('IF((x >= e.k / 2) = (y >= e.k / 2), 0D, 1D)')}, 1D, (t, x) -> t + x)",
         "c": f"aggregate({pair.format('(x - (e.k - 1) / 2) * (y - (e.k - 1) / 2)')}, 0D, (t, x) -> t + x)"},
        {"chi": "e.k / e.n * e.sq - e.n", "m": "2 * e.hi * (e.n - e.hi)",
         "d": f"greatest(1D, e.k * {TEXT_INDEX}D - 1)"},
        {"z1": "abs((e.chi - (e.k - 1)) / sqrt(2 * (e.k - 1) * (e.n - 1) / e.n))",
         # all symbols on one side of the middle: as far off as can be
         "z2": "IF(e.m > e.n, abs((e.r - 1 - e.m / e.n) / sqrt(e.m * (e.m - e.n) / (e.n * e.n * (e.n - 1)))), 9D)",
         "z3": "abs(e.c / ((e.k * e.k - 1) / 12 * sqrt(e.n - 1)))",
         "zt": "((e.k - 1) + e.n * e.d - e.chi) / sqrt(2 * (e.k - 1) + 4 * e.n * e.d)"},
        {"x2": tails},
        {"p_random": "exp(-e.x2) * (1 + e.x2 + e.x2 * e.x2 / 2)",
         "p_text": f"greatest(1e-90D, {_upper_tail('e.zt')})",
         "band": "CASE WHEN e.a IS NOT NULL THEN int(floor(log2(e.n))) END"},
    ]


def battery(tokens: str) -> Column:
    """Of an array column of tokens: an array of (token, p_random: Fisher over
    the three tests, p_text, band); nulls where no encoding is inferred."""
    out = f"transform({tokens}, t -> named_struct('token', t, 's', regexp_replace(t, '=+$', '')))"
    have = ["token", "s"]
    for step in _steps():
        keep = ["token", "p_random", "p_text", "band"] if "band" in step else have + list(step)
        fields = ", ".join(f"'{c}', {step[c] if c in step else 'e.' + c}" for c in keep)
        out, have = f"transform({out}, e -> named_struct({fields}))", keep
    return F.expr(out)


def grid_step(p: Column) -> Column:
    return F.least(F.lit(GRID_END), F.floor(-F.log(p) * GRID)).cast("int")


def thresholds(tested: DataFrame, fdr: float = FDR) -> DataFrame:
    """Per band the least grid step whose tokens are all discoveries: one row
    per band (lengths are powers of two: a few dozen at most)."""
    counts = tested.where(F.col("band").isNotNull()).groupBy("band", grid_step(F.col("p_text")).alias("step")) \
        .agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("band")
    up = counts.withColumn("below", F.sum("n").over(w.orderBy(F.desc("step")))) \
        .withColumn("all", F.sum("n").over(w))
    # tokens of a step have p at most exp(-step / GRID)
    ok = F.exp(-F.col("step") / F.lit(GRID)) * F.col("all") <= F.lit(fdr) * F.col("below")
    return up.where(ok).groupBy("band").agg(F.min("step").alias("least_step"))


def judged(tested: DataFrame, limits: DataFrame, keep: float = KEEP) -> DataFrame:
    """``tested`` plus boolean ``is_random``."""
    j = tested.join(F.broadcast(limits.withColumnRenamed("band", "_band")), F.col("band") == F.col("_band"), "left")
    yes = (grid_step(F.col("p_text")) >= F.col("least_step")) & (F.col("p_random") >= keep)
    return j.withColumn("is_random", F.coalesce(yes, F.lit(False))).drop("_band", "least_step")


def _pieces(text: Column, pattern: str, kind: int) -> Column:
    """The text cut at its matches: odd pieces are matches; null if none."""
    marked = F.regexp_replace(F.translate(text, "\u0001", "\u0002"), pattern, "\u0001$0\u0001")
    cut = F.transform(F.split(marked, "\u0001"), lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), F.length(x).alias("len"),
        F.when(i % 2 == 1, x).alias("token")))
    return F.when(text.rlike(pattern), cut).otherwise(F.array().cast("array<struct<kind:int,i:int,len:int,token:string>>"))


def scan(df: DataFrame, *, key: str = "doc_id", text: str = "text", fdr: float = FDR) -> DataFrame:
    """A row per row of ``df``: the key, the number of base spans of each
    kind, ``base`` and ``spans`` (arrays of kind:start:end in order)."""
    rows = df.select(F.monotonically_increasing_id().alias("_rid"), F.col(key).alias("_key"),
                     F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_t"))
    found = rows.select("_rid", "_key", F.explode_outer(F.concat(*[
        _pieces(F.col("_t"), p, k) for k, p in enumerate((ASSIGN, ACCESS, HEX, CANDIDATE))])).alias("p")) \
        .select("_rid", "_key", "p.*").where(F.col("i").isNull() | (F.col("len") > 0))
    own = F.when(F.col("kind") == 3, F.col("token"))
    tested = found.withColumn("_own", F.filter(F.array(own), lambda t: t.isNotNull()))
    tested = tested.withColumn("_b", F.get(battery("_own"), F.lit(0))) \
        .select("_rid", "_key", "kind", "i", "len", "token", "_b.p_random", "_b.p_text", "_b.band")
    tested = table(tested, "tokens")
    rows = judged(tested, thresholds(tested, fdr)).repartition("_rid")
    end = F.sum("len").over(Window.partitionBy("_rid", "kind").orderBy("i"))
    rows = rows.withColumn("end", end).withColumn("start", F.col("end") - F.col("len"))
    good = F.col("token").isNotNull() & (
        F.when(F.col("kind") == 0, F.length(F.regexp_extract("token", ASSIGN, 2)) >= ASSIGN_LEAST)
        .when(F.col("kind") == 3, F.col("is_random")).otherwise(F.lit(True)))
    named = F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1),
                        F.col("start").cast("string"), F.col("end").cast("string"))
    span = F.when(good, F.struct("start", "kind", named.alias("name")))
    got = rows.groupBy("_rid", "_key").agg(F.array_sort(F.collect_list(span)).alias("all"))  # one document's spans
    count = lambda k: F.size(F.filter("all", lambda s: s["kind"] == k)).cast("long")
    return got.select(F.col("_key").alias(key), *[count(k).alias(f"n_{KINDS[k]}") for k in range(3)],
                      F.transform(F.filter("all", lambda s: s["kind"] < 3), lambda s: s["name"]).alias("base"),
                      F.transform("all", lambda s: s["name"]).alias("spans"))


def _free(name: str, taken: list[str]) -> str:
    while name.lower() in (c.lower() for c in taken):
        name += "_"
    return name


def redact(df: DataFrame, *, text: str = "text", mark: str = "[SECRET]", fdr: float = FDR) -> DataFrame:
    """``df`` with its secrets replaced, each where it stands: matches of the fixed patterns (an
    assignment keeps its name) and the tokens that the battery reports."""
    tokens = F.regexp_extract_all(F.col(text), F.lit(CANDIDATE), F.lit(0))
    words = df.select(tokens.alias("_w")).where(F.size("_w") > 0).select(F.inline(battery("_w")))
    limits = thresholds(words, fdr)
    # one row per length band, so a literal of a few dozen numbers
    steps = {r.band: r.least_step for r in limits.collect()}
    m = F.lit(mark.replace("\\", "\\\\").replace("$", "\\$"))
    t = F.col(text)
    # a value that is too short is taken over as it is, and consumed like a match
    short = ASSIGN.replace(r"([A-Za-z0-9+/_.=-]+)", r"")
    marked = F.regexp_replace(t, F.lit(f"({short})(?:[A-Za-z0-9+/_.=-]{{{ASSIGN_LEAST},}}+|([A-Za-z0-9+/_.=-]+))"),
                              F.lit("$1\ufdd0$3\ufdd1"))
    # an empty place becomes the mark, a short value stays
    marked = F.regexp_replace(F.regexp_replace(marked, F.lit("\ufdd0\ufdd1"), m), "[\ufdd0\ufdd1]", "")
    t = F.when(t.rlike(ASSIGN), marked).otherwise(t)
    t = F.regexp_replace(F.regexp_replace(t, F.lit(ACCESS), m), F.lit(HEX), m)
    if not steps:
        return df.withColumn(text, t)
    least = F.create_map(*[F.lit(x) for kv in steps.items() for x in kv])
    part, word = _free("_part", df.columns), _free("_word", df.columns)
    # the text's pieces between its candidates, one more than these
    cut = df.withColumn(text, t).withColumns({
        part: F.split(F.col(text), CANDIDATE, -1), word: F.regexp_extract_all(F.col(text), F.lit(CANDIDATE), F.lit(0))})
    bad = lambda e: (e["band"].isNotNull() & (grid_step(e["p_text"]) >= least[e["band"]]) & (e["p_random"] >= KEEP))
    kept = F.transform(battery(f"`{word}`"), lambda e: F.when(bad(e), F.lit(mark)).otherwise(e["token"]))
    rest = F.zip_with(kept, F.slice(F.col(part), F.lit(2), F.size(word)), lambda a, b: F.concat(a, b))
    clean = F.concat(F.get(F.col(part), F.lit(0)), F.array_join(rest, ""))
    return cut.withColumn(text, F.when(F.size(word) > 0, clean).otherwise(F.col(text))).drop(part, word)
