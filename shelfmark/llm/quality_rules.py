"""Quality rules with host verdicts, in DataFrame functions only.

Per document: counts of words, symbols, repeated lines and repeated five-word
windows.  Base rule: fewer than 10 words, or more than 20 % of the words in
repeated windows.  Further limits (symbols per word, share of repeated lines)
depend on the host: failures of any rule are summed by host, each host's rate
is shrunk towards the mean with a beta prior whose strength is estimated from
the spread of the rates over all hosts (moments), and the shrunk rate gives the
host's verdict, which is joined back to its documents:

* `trusted` (rate <= 0.02): only the base rule rejects,
* `ordinary`: the limits apply as stated,
* `bad` (rate > 0.5): limits of half the size apply.

A document without symbols and repeats stays on any host.

Defined results: null text has no words and so fails; a null host is a host of
its own; repeated rows are judged like any other row and each counts for its
host; an empty table gives an empty result.  Extra columns of any name are
carried in a struct and never read.

The counts of a document are built inside its row (arrays of word hashes,
neighbours compared after one sort), so nothing is exploded or shuffled but
one partial aggregate per host and the host join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import documents, materialise

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PCT = 20
TRUSTED_RATE = 0.02
BAD_RATE = 0.5
# A document fails where symbols exceed n_words / 10, or repeated lines half of its lines.
SYMBOLS = "#*$%&|<>"
SYMBOL_SHARE = 10
DUP_LINE_PCT = 50


def _words(text: Column) -> Column:
    spaces = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    return F.array_remove(F.split(spaces, " "), "")


def features(docs: DataFrame, text: Column) -> DataFrame:
    """Add `_n_words _word_chars _n_symbols _n_lines _n_dup_lines _n_repeat_words` to the columns."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, " \t\x0b\x0c\r", "")) > 0)
    # Word hashes; every further step works on longs.
    one = docs.withColumns({
        "_wh": F.transform(_words(t), lambda w: F.xxhash64(w)),
        "_lines": lines,
        "_word_chars": F.length(F.translate(t, " \t\n\x0b\x0c\r", "")).cast("long"),
        "_n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
    })
    n = F.size("_wh")
    wins = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get("_wh", i + k) for k in range(WINDOW)])))
    two = one.withColumns({
        "_n_words": n.cast("long"),
        "_win": wins,
        "_n_lines": F.size("_lines").cast("long"),
        "_n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
    }).drop("_wh", "_lines")
    # Only texts with a repeated window pay for the sort of (hash, position).
    repeats = F.size(F.array_distinct("_win")) < F.size("_win")
    three = two.withColumn("_sorted", F.when(repeats, F.sort_array(F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, i, d: F.coalesce(F.get("_sorted", i + d)["h"] == x["h"], F.lit(False))
    four = three.drop("_win").withColumn("_at", F.sort_array(F.transform(
        F.filter("_sorted", lambda x, i: F.when(i > 0, same(x, i, -1)).otherwise(False) | same(x, i, 1)), lambda x: x["i"])))
    step = F.transform("_at", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_at", i + 1) - p, F.lit(WINDOW))))
    total = F.aggregate(step, F.lit(0).cast("long"), lambda a, x: a + x)
    return four.withColumn("_n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).drop("_sorted", "_at")


def _base_failed() -> Column:
    return (F.col("_n_words") < MIN_WORDS) | (100 * F.col("_n_repeat_words") > MAX_REPEAT_PCT * F.col("_n_words"))


def _soft_failed(part: int) -> Column:
    """Limits divided by `part`."""
    return ((SYMBOL_SHARE * part * F.col("_n_symbols") > F.col("_n_words"))
            | (100 * part * F.col("_n_dup_lines") > DUP_LINE_PCT * F.col("_n_lines")))


def host_verdicts(marked: DataFrame) -> DataFrame:
    """One row per host: `_host`, `_host_rate` (shrunk), `_host_verdict`."""
    failed = _base_failed() | _soft_failed(1)
    hosts = materialise(marked.groupBy("_host").agg(F.count(F.lit(1)).alias("n"), F.sum(failed.cast("long")).alias("k")), "hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.count(F.lit(1)).alias("h"))
    mean = (F.col("k") / F.col("n")).alias("m")
    mean_col = total.select(mean).scalar()
    # Between-host share of the variance (rho) by moments; the prior weighs 1/rho - 1 documents.
    spread = (hosts.withColumn("m", mean_col).agg(
        F.first("m").alias("m"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("h"),
        F.sum(F.col("n") * (F.col("k") / F.col("n") - F.col("m")) * (F.col("k") / F.col("n") - F.col("m"))).alias("ss")))
    v = F.col("m") * (1 - F.col("m"))
    noise = (F.col("h") - 1) / F.col("n")
    rho = F.when((v > 0) & (noise < 1), (F.col("ss") / F.col("n") / v - noise) / (1 - noise)).otherwise(F.lit(0.0))
    weight = spread.select((1 / F.greatest(F.lit(1e-6), F.least(F.lit(0.999), rho)) - 1).alias("c")).scalar()
    rated = hosts.withColumns({"m": mean_col, "c": weight})
    rate = (F.col("k") + F.col("c") * F.col("m")) / (F.col("n") + F.col("c"))
    return (rated.select("_host", rate.alias("_host_rate"))
            .withColumn("_host_verdict", F.when(F.col("_host_rate") <= TRUSTED_RATE, "trusted").when(F.col("_host_rate") > BAD_RATE, "bad").otherwise("ordinary")))


def judge(docs: DataFrame, text_col: str = "text", host_col: str = "source", carry: list[str] | None = None) -> DataFrame:
    """Every row with its counts and verdict; `carry` columns (default all) ride along in `_row`."""
    carried = [F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)]
    rows = docs.select(F.struct(*carried).alias("_row"), F.col(host_col).alias("_host"), F.col(text_col).alias("_text"))
    marked = materialise(features(rows, F.col("_text")).drop("_text"), "rules", "snappy")
    verdicts = host_verdicts(marked)
    joined = marked.join(verdicts, marked["_host"].eqNullSafe(verdicts["_host"])).drop(verdicts["_host"])
    soft = (F.when(F.col("_host_verdict") == "trusted", F.lit(False)).when(F.col("_host_verdict") == "bad", _soft_failed(2)).otherwise(_soft_failed(1)))
    return joined.withColumns({"_base_failed": _base_failed(), "_kept": ~_base_failed() & ~soft})


def keep_good(docs: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The rows that stay, with their own columns."""
    return judge(docs, text_col, host_col).filter("_kept").select("_row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: rules and host verdicts over the whole documents table."""
    out = judge(documents(spark, sf_dir), carry=["doc_id"])
    return out.select("_row.doc_id", *[F.col(f"_{c}").alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host_verdict")])


#: Judged rows over `docs` (any relation with doc_id, text, source) as CTEs up to `judged`.
JUDGED_SQL = r"""
r AS (SELECT row_number() OVER () AS rid, *, coalesce(text, '') AS t FROM {docs}),
wl AS (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
              [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls FROM r),
win AS (SELECT rid, i, ws[i:i+4] AS w FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM wl)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, CAST(sum(least(5, coalesce(nxt - i, 5))) AS BIGINT) AS n
        FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM rep) GROUP BY rid),
f AS (SELECT r.*, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, CAST(len(ls) AS BIGINT) AS n_lines,
        CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words
      FROM r JOIN wl USING (rid) LEFT JOIN cov USING (rid)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
        10 * n_symbols > n_words OR 100 * n_dup_lines > 50 * n_lines AS soft,
        20 * n_symbols > n_words OR 200 * n_dup_lines > 50 * n_lines AS strict FROM f),
h AS (SELECT source AS host, count(*) AS n, sum((base_failed OR soft)::INT) AS k FROM b GROUP BY source),
p AS (SELECT m, docs_n, hosts_n, sum(n * (k / n - m) * (k / n - m)) AS ss
      FROM h, (SELECT sum(k) / sum(n) AS m, sum(n) AS docs_n, count(*) AS hosts_n FROM h) GROUP BY m, docs_n, hosts_n),
q AS (SELECT m, CASE WHEN m * (1 - m) > 0 AND (hosts_n - 1) / docs_n < 1
        THEN (ss / docs_n / (m * (1 - m)) - (hosts_n - 1) / docs_n) / (1 - (hosts_n - 1) / docs_n) ELSE 0 END AS rho FROM p),
v AS (SELECT host, (k + c * m) / (n + c) AS rate FROM h, (SELECT m, 1 / greatest(1e-6, least(0.999, rho)) - 1 AS c FROM q)),
judged AS (SELECT b.*, CASE WHEN rate <= 0.02 THEN 'trusted' WHEN rate > 0.5 THEN 'bad' ELSE 'ordinary' END AS host_verdict,
        NOT base_failed AND NOT (CASE WHEN rate <= 0.02 THEN false WHEN rate > 0.5 THEN strict ELSE soft END) AS kept
      FROM b JOIN v ON b.source IS NOT DISTINCT FROM v.host)"""

ORACLE = "WITH " + JUDGED_SQL.replace("{docs}", "documents") + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, host_verdict FROM judged"""
