"""Rule tables over texts: detection, levels, confidence, complexity, error categories."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone import rules as R
from siltstone.operators import rules as ops
from siltstone.plans.metrics import _DKEY, _KEY
from siltstone.plans.registry import query
from siltstone.session import evenly, spread, table
from siltstone.sources.messages import message_sql
from siltstone.sources.samples import CODE, dealt, quoted, sql_dealt

_CODE = f"(SELECT doc_id, {sql_dealt(CODE, 'doc_id')} || text AS code FROM documents)"


def code_of(spark, sf):
    """(doc_id, code): sample code in front of each whole document."""
    d = table(spark, sf, "documents")
    return spread(d.select("doc_id", "text")).select("doc_id", F.concat(dealt(CODE, F.col("doc_id")), F.col("text")).alias("code"))


def _hit(r: ops.Rule, flags: str = "m", c: str = "code") -> str:
    return f"contains({c}, {quoted(r.pattern)})" if r.literal else f"regexp_matches({c}, {quoted(f'(?{flags}){r.pattern}')})"


def _count(r: ops.Rule, c: str = "code") -> str:
    if "(?=" in r.pattern:  # DuckDB cannot look ahead; only a text with the mark looked for could match, and would show as null
        return f"CASE WHEN contains({c}, '# undefined') THEN NULL ELSE 0 END"
    return f"len(regexp_extract_all({c}, {quoted(f'(?m){r.pattern}')}))"


def _matched(rules, flags="m") -> str:
    return "array_to_string([x FOR x IN [" + ", ".join(f"CASE WHEN {_hit(r, flags)} THEN '{r.name}' END" for r in rules) + "] IF x IS NOT NULL], ',')"


@query("rule_match_matrix", f"SELECT doc_id, {_matched(R.UNFIXABLE)} AS found FROM {_CODE}")
def rule_match_matrix(spark, sf):
    """Names of the unfixable patterns that occur."""
    return code_of(spark, sf).select("doc_id", F.array_join(ops.matched(F.col("code"), R.UNFIXABLE), ",").alias("found"))


@query("rule_match_screened", f"SELECT doc_id, {_matched(R.UNFIXABLE + R.HIGH_RISK)} AS found FROM {_CODE}")
def rule_match_screened(spark, sf):
    """Names of the unfixable and risky patterns that occur, tried only where a literal that they need occurs."""
    from siltstone.operators.screening import matched_if_worth

    d = matched_if_worth(code_of(spark, sf), "code", R.UNFIXABLE + R.HIGH_RISK, "found")
    return d.select("doc_id", F.array_join("found", ",").alias("found"))


_RANK = "greatest(0, " + ", ".join(f"CASE WHEN {_hit(r)} THEN {R.LEVELS.index(r.level)} ELSE 0 END" for r in R.UNFIXABLE) + ")"
_CORRUPT = """(CASE WHEN regexp_matches(code, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F-\\x{FF}]') THEN 1 ELSE 0 END
    + CASE WHEN len(regexp_extract_all(code, '[a-zA-Z_]')) < length(code) * 0.3 THEN 1 ELSE 0 END
    + CASE WHEN length(trim(code)) BETWEEN 1 AND 9 THEN 1 ELSE 0 END
    + CASE WHEN regexp_matches(code, 'def|class|import|from|if|for|while|return') THEN 0 ELSE 1 END)"""


@query(
    "fixability_level",
    f"""
    SELECT doc_id, level, corrupt, level = 'definitely_unfixable' OR (level = 'likely_unfixable' AND doc_id % 2 = 1) AS skip
    FROM (SELECT doc_id, CASE {_RANK} WHEN 2 THEN 'definitely_unfixable' WHEN 1 THEN 'likely_unfixable' ELSE 'fixable' END AS level,
                 {_CORRUPT} >= 2 AS corrupt FROM {_CODE})
    """,
)
def fixability_level(spark, sf):
    """Worst level of the patterns found, corruption of the text, and whether to skip at this attempt."""
    code = F.col("code")
    signs = [
        code.rlike(r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\xFF]"),
        F.regexp_count(code, F.lit("[a-zA-Z_]")) < F.length(code) * 0.3,
        F.length(F.trim(code)).between(1, 9),
        ~code.rlike("def|class|import|from|if|for|while|return"),
    ]
    d = code_of(spark, sf).select(
        "doc_id", ops.worst_level(code, R.UNFIXABLE, R.LEVELS).alias("level"), (sum(s.cast("int") for s in signs) >= 2).alias("corrupt")
    )
    skip = (F.col("level") == R.LEVELS[2]) | ((F.col("level") == R.LEVELS[1]) & (F.col("doc_id") % 2 == 1))
    return d.withColumn("skip", skip)


@query(
    "fixability_report",
    f"""
    SELECT level, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6)::DOUBLE AS percent
    FROM (SELECT CASE {_RANK} WHEN 2 THEN 'definitely_unfixable' WHEN 1 THEN 'likely_unfixable' ELSE 'fixable' END AS level FROM {_CODE}) GROUP BY level
    """,
)
def fixability_report(spark, sf):
    """Counts and shares of the levels."""
    n = fixability_level(spark, sf).groupBy("level").agg(F.count("*").alias("n"))
    return n.join(n.agg(F.sum("n").alias("total")), how="cross").select("level", "n", F.round(F.lit(100.0) * F.col("n") / F.col("total"), 6).alias("percent"))


def _prio(p: str) -> str:
    return " + ".join(f"CASE WHEN {_hit(r, 'ms')} THEN 1 ELSE 0 END" for r in R.HIGH_RISK if r.level == p)


_FACTORS = " * ".join(f"CASE WHEN {_hit(r, 'ms')} THEN {1.0 - r.weight!r}::DOUBLE ELSE 1.0::DOUBLE END" for r in R.HIGH_RISK)


@query(
    "fallback_score",
    f"""
    SELECT doc_id, round(c2, 6) AS confidence, high > 0 OR c2 < 0.7 OR medium >= 2 AS triggered
    FROM (SELECT doc_id, medium, high + CASE WHEN high >= 2 THEN 1 ELSE 0 END AS high, c1 * CASE WHEN high >= 2 THEN 0.7::DOUBLE ELSE 1.0::DOUBLE END AS c2
          FROM (SELECT doc_id, 0.9::DOUBLE * CASE WHEN fixes >= 35 THEN 0.6::DOUBLE WHEN fixes >= 30 THEN 0.8::DOUBLE ELSE 1.0::DOUBLE END * {_FACTORS} AS c1,
                       {_prio('high')} + CASE WHEN fixes >= 35 THEN 1 ELSE 0 END AS high,
                       {_prio('medium')} + CASE WHEN fixes >= 30 AND fixes < 35 THEN 1 ELSE 0 END AS medium
                FROM (SELECT *, doc_id % 40 AS fixes FROM {_CODE})))
    """,
)
def fallback_score(spark, sf):
    """Confidence damped by risky patterns and many fixes, and whether that triggers the fallback."""
    code, fixes = F.col("code"), F.col("doc_id") % 40
    start = F.lit(0.9) * F.when(fixes >= 35, 0.6).when(fixes >= 30, 0.8).otherwise(1.0)
    n = lambda p: sum(ops.hits(code, r, "ms").cast("int") for r in R.HIGH_RISK if r.level == p)
    d = code_of(spark, sf).select(
        "doc_id",
        ops.damped(start, code, R.HIGH_RISK, "ms").alias("c1"),
        (n("high") + (fixes >= 35).cast("int")).alias("high"),
        (n("medium") + ((fixes >= 30) & (fixes < 35)).cast("int")).alias("medium"),
    )
    c2 = F.col("c1") * F.when(F.col("high") >= 2, 0.7).otherwise(1.0)
    return d.select("doc_id", F.round(c2, 6).alias("confidence"), ((F.col("high") > 0) | (c2 < 0.7) | (F.col("medium") >= 2)).alias("triggered"))


_COMPLEX = " + ".join(f"{_count(r)} * {int(r.weight)}" for r in R.COMPLEXITY) + " + len(string_split(code, chr(10))) // 50"


@query("complexity_score", f"SELECT doc_id, ({_COMPLEX})::BIGINT AS complexity FROM {_CODE}")
def complexity_score(spark, sf):
    """Weighted occurrences of complex constructs."""
    lines = F.floor(F.size(F.split("code", "\n")) / 50)
    return code_of(spark, sf).select("doc_id", (ops.occurrences(F.col("code"), R.COMPLEXITY) + lines).cast("long").alias("complexity"))


_PROBLEMS = " + ".join(f"CASE WHEN {_hit(r)} THEN 1 ELSE 0 END" for r in R.PROBLEMATIC)
_RUNTIME = " + ".join(_count(r) for r in R.RUNTIME)


@query(
    "precheck_confidence",
    f"""
    SELECT doc_id, round(CASE WHEN p > 0 THEN greatest(0.2, 1 - 0.1 * p) ELSE 1 END * CASE WHEN c > 10 THEN 0.8 WHEN c > 5 THEN 0.9 ELSE 1 END, 6)::DOUBLE AS before_score,
           round(greatest(0.1, 1 - 0.2 * r), 6)::DOUBLE AS after_score, greatest(0.1, 1 - 0.2 * r) < 0.6 OR r > 3 AS use_fallback
    FROM (SELECT doc_id, {_PROBLEMS} AS p, {_COMPLEX} AS c, {_RUNTIME} AS r FROM {_CODE})
    """,
)
def precheck_confidence(spark, sf):
    """Confidence before (damage, complexity) and after conversion (what fails when it runs)."""
    code = F.col("code")
    lines = F.floor(F.size(F.split("code", "\n")) / 50)
    d = code_of(spark, sf).select(
        "doc_id",
        sum(ops.hits(code, r).cast("int") for r in R.PROBLEMATIC).alias("p"),
        (ops.occurrences(code, R.COMPLEXITY) + lines).alias("c"),
        ops.occurrences(code, R.RUNTIME).alias("r"),
    )
    damage = F.when(F.col("p") > 0, F.greatest(F.lit(0.2), 1 - F.lit(0.1) * F.col("p"))).otherwise(1.0)
    complexity = F.when(F.col("c") > 10, 0.8).when(F.col("c") > 5, 0.9).otherwise(1.0)
    after = F.greatest(F.lit(0.1), 1 - F.lit(0.2) * F.col("r"))
    return d.select("doc_id", F.round(damage * complexity, 6).alias("before_score"), F.round(after, 6).alias("after_score"), ((after < 0.6) | (F.col("r") > 3)).alias("use_fallback"))


@query(
    "issue_validator_confidence",
    """
    SELECT user_id, errors, warnings, round(CASE WHEN errors > 5 THEN 0.1 WHEN errors > 0 THEN 0.3 - 0.05 * errors WHEN warnings > 10 THEN 0.6
        WHEN warnings > 0 THEN 0.8 - 0.02 * warnings ELSE 0.95 END, 6)::DOUBLE AS confidence
    FROM (SELECT user_id, count(*) FILTER (event_type = 'error')::BIGINT AS errors, count(*) FILTER (event_type = 'signup')::BIGINT AS warnings FROM events GROUP BY user_id)
    """,
)
def issue_validator_confidence(spark, sf):
    """Confidence from counts of errors and warnings."""
    e = table(spark, sf, "events").groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "error").alias("errors"), F.count_if(F.col("event_type") == "signup").alias("warnings")
    )
    score = F.expr("CASE WHEN errors > 5 THEN 0.1D WHEN errors > 0 THEN 0.3D - 0.05D * errors WHEN warnings > 10 THEN 0.6D WHEN warnings > 0 THEN 0.8D - 0.02D * warnings ELSE 0.95D END")
    return e.withColumn("confidence", F.round(score, 6))


def _category_sql(c: str) -> tuple[str, str]:
    cat, key = "CASE ", "CASE "
    for name, patterns in R.ERROR_CATEGORIES:
        for p in patterns:
            q = quoted(f"(?i){p}")
            cat += f"WHEN regexp_matches({c}, {q}) THEN '{name}' "
            group = f"regexp_extract({c}, {q}, 1)" if "(" in p.replace("\\(", "") else "NULL"
            key += f"WHEN regexp_matches({c}, {q}) THEN {group} "
    return cat + "ELSE 'unknown_error' END", key + "END"


_CAT, _KEYINFO = _category_sql("message")
_MESSAGES = f"(SELECT event_id, {message_sql(_DKEY)} AS message FROM events)"


@query(
    "error_categorize",
    f"""
    SELECT event_id, {_CAT} AS category, {_KEYINFO} AS key_info,
           CASE {' '.join('WHEN ' + ' AND '.join(f"contains(lower(message), '{w}')" for w in words) + f" THEN '{n}'" for n, words in R.ERROR_LADDER)}
                ELSE lower(array_to_string(regexp_extract_all(message, '[0-9A-Za-z_]+')[1:3], '_')) END AS simple,
           trim(split_part(regexp_replace(regexp_replace(regexp_replace(message, '"[^"]*"', '<path>', 'g'), 'line [0-9]+', 'line N', 'g'), '''[^'']*''', '''X''', 'g'), ':', 1)) AS pattern
    FROM {_MESSAGES}
    """,
)
def error_categorize(spark, sf):
    """Category by pattern table and key, category by word ladder, and the message's general pattern."""
    e = evenly(table(spark, sf, "events").select("event_id", "user_id", "event_type", "props")).select("event_id", F.expr(message_sql(_KEY)).alias("message"))
    m = F.col("message")
    category, key = ops.first_category(m, R.ERROR_CATEGORIES, "unknown_error")
    words = F.regexp_extract_all(m, F.lit("[0-9A-Za-z_]+"), F.lit(0))
    simple = F.lower(F.array_join(F.slice(words, 1, 3), "_"))
    for name, parts in reversed(R.ERROR_LADDER):
        has = F.contains(F.lower(m), F.lit(parts[0]))
        for p in parts[1:]:
            has = has & F.contains(F.lower(m), F.lit(p))
        simple = F.when(has, name).otherwise(simple)
    masked = F.regexp_replace(F.regexp_replace(F.regexp_replace(m, '"[^"]*"', "<path>"), "line [0-9]+", "line N"), "'[^']*'", "'X'")
    return e.select("event_id", category.alias("category"), key.alias("key_info"), simple.alias("simple"), F.trim(F.split_part(masked, F.lit(":"), F.lit(1))).alias("pattern"))


@query(
    "rule_hits_rollup",
    "SELECT rule, level, count(*) AS n FROM ("
    + " UNION ALL ".join(f"SELECT '{r.name}' AS rule, '{r.level}' AS level FROM {_CODE} WHERE {_hit(r)}" for r in R.UNFIXABLE)
    + ") GROUP BY rule, level",
)
def rule_hits_rollup(spark, sf):
    """How often each rule was hit."""
    return ops.exploded(code_of(spark, sf), "doc_id", F.col("code"), R.UNFIXABLE).groupBy("rule", "level").agg(F.count("*").alias("n"))
