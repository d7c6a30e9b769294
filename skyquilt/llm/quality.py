"""Quality rules as weak supervision, in DataFrame expressions only.

``features`` measures a text. ``RULES`` are labelling functions on those measures: each votes 1 (good), -1 (bad) or
abstains (0). ``fit`` learns, from the counts of the vote patterns of *all* rows and without labels, how often each
rule is right when it votes on good and on bad texts, and the share of good texts, by expectation-maximisation. There
are at most 3 ** rules patterns whatever the size of the input, so that the counts are one small aggregate and an
iteration reads that aggregate alone. ``posterior`` is the probability that a text is good given its votes; it takes
the place of a filter that asks every rule to pass.

Defined cases: a null text has no words, and fails; long texts are measured whole; repeated rows count as often as
they occur; on an empty table the model keeps its starting values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyquilt.llm.common import let, materialize, table, words

#: Fixed value of the row contract: characters counted as symbols.
SYMBOLS = "#*$%&|<>"
#: Frequent words of the languages that the tables hold.
STOP_WORDS = (
    "the of and to in is that it was for on are as with be by at this from or an a he "
    "der die und den von zu das mit sich des auf ist im dem nicht ein eine "
    "de la le et les des en un une du que est dans qui par pour au sur "
    "el los se las por con una su para al lo como"
).split()
WINDOW = 8

#: name, measure, when good, when bad. Measures and thresholds are SQL over the columns of ``features``, for Spark and DuckDB.
RULES = [
    ("symbols", "n_symbols / n_words", "< 0.05", "> 0.25"),
    ("dup_lines", "n_dup_lines / n_lines", "= 0", "> 0.3"),
    ("repeats", "n_repeat_words / n_words", "= 0", "> 0.2"),
    ("word_length", "word_chars / n_words", "BETWEEN 3 AND 9", "NOT BETWEEN 2 AND 14"),
    ("capitals", "n_capitals / word_chars", "< 0.1", "> 0.4"),
    ("stop_words", "n_stop_words / n_words", "> 0.12", "< 0.04"),
    ("variety", "n_distinct / n_words", "> 0.3", "< 0.1"),
    ("marks", "n_marks / n_words", "< 0.1", "> 0.4"),
]
#: Where expectation-maximisation starts: share of good texts; how often a vote on a good, on a bad text is right.
START = (0.9, 0.95, 0.6)
ITERATIONS = 12
#: Beta prior (right, wrong) on each rule's accuracies, and bounds on estimates.
PRIOR, BOUNDS = (9.0, 1.0), (0.02, 0.998)


def _translated(text: Column, chars: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def repeat_words(words_col: Column, n: int = WINDOW) -> Column:
    """How many words lie in an ``n``-word window whose words occur twice or more in the text."""

    def covered(hashes: Column) -> Column:
        sorted_ = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        at = let(
            sorted_,
            lambda s: F.sort_array(
                F.transform(
                    F.filter(s, lambda x, i: (F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))),
                    lambda x: x["i"],
                )
            ),
        )
        return let(
            at,
            lambda p: F.aggregate(
                F.transform(p, lambda x, i: F.least(F.lit(n), F.coalesce(F.get(p, i + 1) - x, F.lit(n)))), F.lit(0), lambda a, x: a + x
            ),
        )

    hashes = let(
        words_col,
        lambda w: F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.xxhash64(F.slice(w, i, n)))).otherwise(
            F.array().cast("array<bigint>")
        ),
    )
    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0)))


def features(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns in ``keep`` and the measures of ``text_col``, all bigint."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, " \t\x0b\x0c\r", "") != "")
    base = df.select(*keep, text.alias("t"), words(text).alias("w"), lines.alias("l"))
    low = F.transform("w", lambda x: F.lower(x))
    measures = {
        "n_words": F.size("w"),
        "word_chars": F.char_length(F.translate(F.col("t"), " \t\n\x0b\x0c\r", "")),
        "n_symbols": _translated(F.col("t"), SYMBOLS),
        "n_dup_lines": F.size("l") - F.size(F.array_distinct("l")),
        "n_repeat_words": repeat_words(F.col("w")),
        "n_lines": F.size("l"),
        "n_capitals": F.char_length(F.regexp_replace("t", r"[^\p{Lu}]+", "")),
        "n_marks": _translated(F.col("t"), "!?|"),
        "n_distinct": F.size(F.array_distinct("w")),
        "n_stop_words": F.size("w") - F.size(F.filter(low, lambda x: ~x.isin(*sorted(set(STOP_WORDS))))),
    }
    return base.select(*keep, *[c.cast("long").alias(k) for k, c in measures.items()])


def _vote(measure: str, good: str, bad: str) -> str:
    a, b = measure.split(" / ")
    share = f"({a} / nullif(cast({b} AS DOUBLE), 0))"
    return f"CASE WHEN {share} {good} THEN 1 WHEN {share} {bad} THEN -1 ELSE 0 END"


def votes(df: DataFrame) -> DataFrame:
    """``df`` with ``votes``, the rules' votes in order."""
    return df.withColumn("votes", F.expr("array(" + ", ".join(_vote(*r[1:]) for r in RULES) + ")"))


def posterior_column(model: dict, pattern: Column) -> Column:
    """Probability of a good text by naive Bayes over the rules that vote.

    The parameters come in as one array variable: the plan's code then stays the same from iteration to iteration.
    """
    flat = F.array(*[F.lit(float(x)) for x in (model["share"], *(x for pair in model["right"] for x in pair))])

    def body(m: Column) -> Column:
        def likelihood(good: bool) -> Column:
            terms = [m[0] if good else 1 - m[0]]
            for j in range(len(RULES)):
                g, b, v = m[1 + 2 * j], m[2 + 2 * j], pattern[j]
                up, down = (g, 1 - g) if good else (1 - b, b)
                terms.append(F.when(v == 1, up).when(v == -1, down).otherwise(F.lit(1.0)))
            return reduce(lambda x, y: x * y, terms)

        return likelihood(True) / (likelihood(True) + likelihood(False))

    return let(flat, body)


def fit(patterns: DataFrame, iterations: int = ITERATIONS) -> dict:
    """Expectation-maximisation over ``votes`` and ``n``, their counts; only sums of each iteration reach the driver."""
    model = {"share": START[0], "right": [START[1:]] * len(RULES)}
    for _ in range(iterations):
        p = patterns.withColumn("p", posterior_column(model, F.col("votes")))
        sums = [F.sum(F.col("n") * F.col("p")).alias("good"), F.sum("n").alias("all")]
        for j in range(len(RULES)):
            v, n = F.col("votes")[j], F.col("n")
            for name, vote, weight in (("gr", 1, F.col("p")), ("gw", -1, F.col("p")), ("br", -1, 1 - F.col("p")), ("bw", 1, 1 - F.col("p"))):
                sums.append(F.sum(F.when(v == vote, n * weight).otherwise(0.0)).alias(f"{name}{j}"))
        s = p.agg(*sums).first()
        if not s["all"]:
            break
        inside = lambda x: min(max(x, BOUNDS[0]), BOUNDS[1])
        rate = lambda a, b: inside((a + PRIOR[0]) / (a + b + PRIOR[0] + PRIOR[1]))
        model = {
            "share": inside(s["good"] / s["all"]),
            "right": [(rate(s[f"gr{j}"], s[f"gw{j}"]), rate(s[f"br{j}"], s[f"bw{j}"])) for j in range(len(RULES))],
        }
    return model


def judge(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Measures, ``votes``, ``posterior`` and the verdicts ``base_failed`` and ``kept`` of every row, and its id."""
    measured = materialize(votes(features(df, text_col, (id_col,))), "quality")
    patterns = materialize(measured.groupBy("votes").agg(F.count("*").alias("n")), "vote-patterns")
    model = fit(patterns)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return measured.withColumn("posterior", posterior_column(model, F.col("votes"))).select(
        "*", failed.alias("base_failed"), (~failed & (F.col("posterior") >= threshold)).alias("kept")
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows whose text is kept. Rows are written once beside their votes, so that a text is measured once: for
    the counts that the model is fitted to, and for the verdict. Columns travel in a struct, whatever their names."""
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    measured = votes(features(docs.select(own.alias("__row"), F.col("text").alias("__text")), "__text", ("__row",)))
    measured = materialize(measured.select("__row", "votes", "n_words", "n_repeat_words"), "quality-rows")
    model = fit(materialize(measured.groupBy("votes").agg(F.count("*").alias("n")), "vote-patterns"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    kept = measured.where(~failed & (posterior_column(model, F.col("votes")) >= 0.5))
    return kept.select(*[F.col("__row").getField(c).alias(c) for c in docs.columns])


def _em_sql(iterations: int = ITERATIONS) -> str:
    """Chained CTEs m0 .. mK: one row of parameters each."""
    k = range(len(RULES))
    parts = [
        "m0 AS (SELECT "
        + f"{START[0]}::DOUBLE AS share, "
        + ", ".join(f"{START[1]}::DOUBLE AS g{j}, {START[2]}::DOUBLE AS b{j}" for j in k)
        + ")"
    ]
    good = "share" + "".join(f" * CASE v{j} WHEN 1 THEN g{j} WHEN -1 THEN 1 - g{j} ELSE 1 END" for j in k)
    bad = "(1 - share)" + "".join(f" * CASE v{j} WHEN 1 THEN 1 - b{j} WHEN -1 THEN b{j} ELSE 1 END" for j in k)
    lo, hi = BOUNDS
    inside = lambda x: f"least(greatest({x}, {lo}), {hi})"
    side = lambda v, w: f"sum(CASE WHEN {v} THEN n * {w} ELSE 0 END)"
    for i in range(iterations):
        cols = [inside("sum(n * p) / sum(n)") + " AS share"]
        for j in k:
            for name, right, wrong, w in (("g", 1, -1, "p"), ("b", -1, 1, "(1 - p)")):
                a, b = side(f"v{j} = {right}", w), side(f"v{j} = {wrong}", w)
                cols.append(inside(f"({a} + {PRIOR[0]}) / ({a} + {b} + {PRIOR[0] + PRIOR[1]})") + f" AS {name}{j}")
        parts.append(f"q{i} AS MATERIALIZED (SELECT pat.*, ({good}) / (({good}) + ({bad})) AS p FROM pat, m{i})")
        parts.append(f"m{i + 1} AS MATERIALIZED (SELECT {', '.join(cols)} FROM q{i})")
    parts.append(f"post AS (SELECT {', '.join(f'v{j}' for j in k)}, ({good}) / (({good}) + ({bad})) AS p FROM pat, m{iterations})")
    return ",\n".join(parts)


_V = ", ".join(f"v{j}" for j in range(len(RULES)))
#: Common table expressions up to ``judged``, over a relation named DOCS.
JUDGED_SQL = f"""
t AS (SELECT *, coalesce(text, '') AS x, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM DOCS),
wx AS (
  SELECT w, i, array_to_string(w[i:i+{WINDOW - 1}], ' ') AS g FROM (SELECT w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM (SELECT DISTINCT w FROM t))
),
rep AS (SELECT w, i, lead(i) OVER (PARTITION BY w ORDER BY i) AS nxt FROM (SELECT w, i, count(*) OVER (PARTITION BY w, g) AS c FROM wx) WHERE c > 1),
cov AS (SELECT w, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW})))::BIGINT AS n_repeat_words FROM rep GROUP BY w),
ln AS (SELECT *, list_filter(string_split(x, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS l FROM t),
f AS (
  SELECT ln.*, len(ln.w) AS n_words, length(regexp_replace(x, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(x, '[^{SYMBOLS}]+', '', 'g')) AS n_symbols,
    len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, len(l) AS n_lines,
    length(regexp_replace(x, '[^\\p{{Lu}}]+', '', 'g')) AS n_capitals, length(regexp_replace(x, '[^!?|]+', '', 'g')) AS n_marks,
    len(list_distinct(ln.w)) AS n_distinct,
    len(list_filter(ln.w, lambda y: lower(y) IN ({", ".join(repr(s) for s in sorted(set(STOP_WORDS)))}))) AS n_stop_words
  FROM ln LEFT JOIN cov ON ln.w = cov.w
),
v AS (SELECT *, {", ".join(f"{_vote(*r[1:])} AS v{j}" for j, r in enumerate(RULES))} FROM f),
pat AS MATERIALIZED (SELECT {_V}, count(*) AS n FROM v GROUP BY ALL),
{_em_sql()},
judged AS (
  SELECT v.*, p, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed FROM v JOIN post USING ({_V})
)
"""
OP6_SQL = (
    "WITH "
    + JUDGED_SQL.replace("DOCS", "documents")
    + """SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words, base_failed, (NOT base_failed AND p >= 0.5) AS kept FROM judged"""
)
