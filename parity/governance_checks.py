"""PII, tag, access, lint and audit queries."""

from pyspark.sql import functions as F

from parity.registry import check
from tarnlake.operators import access, audit, lineage, lint, pii, tags
from tarnlake.operators.upsert import upsert
from tarnlake.plans.governance import TAG_COLUMNS, pii_scan, pii_scan_raw, reconcile_tags, scan_raw_folders
from tarnlake.session import new_path
from tarnlake.sinks.exchange import Folder
from tarnlake.sources import policy
from tarnlake.sources.files import file_inventory, read_audit_log

PATTERNS = pii.CONTENT_PATTERNS
KINDS = list(PATTERNS)


def matches(value, kind):
    pattern = PATTERNS[kind].replace("'", "''")
    return f"regexp_matches({value}, '{pattern}')"


def clean(value):
    return f"trim(trim(trim({value}), '\"'), '''')"


def profile_sql(columns, source):
    """One row per column: non-NULL cells and hits per pattern."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS cells, " + ", ".join(
            f"count(*) FILTER (WHERE {matches(clean(f'CAST({c} AS VARCHAR)'), k)}) AS {k}_hits" for k in KINDS)
        + f" FROM {source}" for c in columns)


PATTERN_LIST = "concat_ws(',', " + ", ".join(f"CASE WHEN {k}_hits > 0 THEN '{k}' END" for k in KINDS) + ")"
NAME_KEY = "replace(replace(lower({c}), '_', ''), '-', '')"


def name_kind_sql(column):
    key = NAME_KEY.format(c=column)
    branches = " ".join(
        "WHEN " + " OR ".join(f"contains({key}, '{w}')" for w in words) + f" THEN '{kind}'"
        for kind, words in pii.NAME_MARKERS.items())
    return f"CASE {branches} END"


def detected_sql(profile):
    return f"""
        SELECT "column", 'direct' AS pii, CASE WHEN {name_kind_sql('"column"')} IS NOT NULL THEN 'name'
          ELSE 'content' END AS source, {PATTERN_LIST} AS patterns
        FROM ({profile}) WHERE {name_kind_sql('"column"')} IS NOT NULL OR {PATTERN_LIST} <> ''"""


CUSTOMER = ["customer_id", "first_name", "last_name", "email", "phone_number", "ssn", "country", "region_code"]
PLAIN = {"a": "customer_id", "b": "email", "c": "phone_number", "d": "ssn", "e": "country"}


@check(detected_sql(profile_sql(CUSTOMER, "v_customers")))
def pii_columns(t):
    return pii.detect_pii(t("v_customers").select(*CUSTOMER))


# The same cells under names that say nothing: only their content can flag them.
@check(f"""SELECT *, {PATTERN_LIST} AS patterns, 'direct' AS pii FROM ({profile_sql(list(PLAIN), "cells")})
    WHERE {PATTERN_LIST} <> ''""",
       cells="SELECT " + ", ".join(f"concat(' \"', {c}, '\" ') {n}" for n, c in PLAIN.items()) + " FROM v_customers")
def pii_by_content(t):
    cells = t("v_customers").select(
        *[F.concat(F.lit(' "'), F.col(c), F.lit('" ')).alias(n) for n, c in PLAIN.items()])
    return pii.pii_by_content(cells)


@check(f"""SELECT *, {PATTERN_LIST} AS patterns FROM (
    {profile_sql(["event_id", "user_id", "event_type", "props"], "events")})""")
def content_profile(t):
    return pii.content_profile(t("events").select("event_id", "user_id", "event_type", "props"))


@check(f"""SELECT db, tbl, col, kind, 'direct' AS pii FROM (
      SELECT db, tbl, col, {name_kind_sql('col')} AS kind FROM v_columns) WHERE kind IS NOT NULL""")
def pii_by_name(t):
    return pii.pii_by_name(t("v_columns").select("db", "tbl", "col"), "col")


LINE_COLUMNS = ["id", "contact", "number", "ssn_num", "last"]


@check(detected_sql(profile_sql(LINE_COLUMNS, "cells")),
       cells="SELECT " + ", ".join(f"p[{i + 1}] {c}" for i, c in enumerate(LINE_COLUMNS)) + """ FROM (
         SELECT string_split(concat(customer_id, ',', email, ',', phone_number, ',', ssn, ',',
           CASE WHEN c_custkey % 4 = 0 THEN 'a,b' ELSE last_name END), ',') AS p FROM v_customers) AS lines
         WHERE len(p) = 5""")
def pii_in_lines(t):
    last = F.when(F.col("c_custkey") % 4 == 0, "a,b").otherwise(F.col("last_name"))
    lines = t("v_customers").select(
        F.concat_ws(",", "customer_id", "email", "phone_number", "ssn", last).alias("value"))
    return pii.detect_pii_in_lines(lines, LINE_COLUMNS)


def text_hits(table, by):
    token = clean("tok")
    hits = ", ".join(f"count(*) FILTER (WHERE {matches(token, k)}) AS {k}_hits" for k in KINDS)
    return f"""SELECT {by}, {hits} FROM (
        SELECT {by}, unnest(regexp_split_to_array(text, '\\s+')) AS tok FROM {table}) GROUP BY {by}"""


@check(text_hits("documents", "source"))
def pii_documents(t):
    return pii.pii_in_text(t("documents"), "text", ["source"])


@check(text_hits("conversations", "role"))
def pii_conversations(t):
    return pii.pii_in_text(t("conversations"), "text", ["role"])


# --- tags -----------------------------------------------------------------

def values(rows):
    def one(x):
        return "NULL" if x is None else "'" + x + "'"
    return ", ".join("(" + ", ".join(one(x) for x in row) + ")" for row in rows)


DB_ROWS = [(d, r.get("bu"), r.get("default_sensitivity"), r.get("default_pii"))
           for d, r in policy.DATABASE_POLICIES.items()]
TABLE_ROWS = [(d, t, p.get("bu"), p.get("sensitivity"))
              for d, r in policy.DATABASE_POLICIES.items() for t, p in r.get("tables", {}).items()]
COLUMN_ROWS = [(d, t, c, v) for d, r in policy.DATABASE_POLICIES.items()
               for t, p in r.get("tables", {}).items() for c, v in p.get("columns", {}).items()]
TAXONOMY_ROWS = [(k, v) for k, vs in policy.TAXONOMY.items() for v in vs]

POLICY = dict(
    p_db=f"SELECT * FROM (VALUES {values(DB_ROWS)}) x(db, bu0, sens0, pii0)",
    p_table=f"SELECT * FROM (VALUES {values(TABLE_ROWS)}) x(db, tbl, bu, sens)",
    p_column=f"SELECT * FROM (VALUES {values(COLUMN_ROWS)}) x(db, tbl, col, pii)",
    known="SELECT DISTINCT db, tbl, col FROM v_columns",
    expected="""
        SELECT k.db, k.tbl, '' AS col, 'BU' AS tag, coalesce(bu, bu0, 'operations') AS val
        FROM (SELECT DISTINCT db, tbl FROM known) k JOIN p_db d ON k.db = d.db
          LEFT JOIN p_table p ON p.db = k.db AND p.tbl = k.tbl
        UNION ALL
        SELECT k.db, k.tbl, '', 'Sensitivity', coalesce(sens, sens0, 'internal')
        FROM (SELECT DISTINCT db, tbl FROM known) k JOIN p_db d ON k.db = d.db
          LEFT JOIN p_table p ON p.db = k.db AND p.tbl = k.tbl
        UNION ALL
        SELECT k.db, k.tbl, k.col, 'PII', coalesce(pii, pii0, 'none')
        FROM known k JOIN p_db d ON k.db = d.db
          LEFT JOIN p_column p ON p.db = k.db AND p.tbl = k.tbl AND p.col = k.col""",
    drift="""
        SELECT e.db, e.tbl, e.col, e.tag, t.val AS old, e.val AS new
        FROM expected e LEFT JOIN v_tags t ON e.db = t.db AND e.tbl = t.tbl AND e.col = t.col AND e.tag = t.tag
        WHERE t.val IS DISTINCT FROM e.val""",
)
NAMED = 'db AS "database", tbl AS "table", col AS "column", tag'


def catalog(t):
    return t.sql("SELECT DISTINCT db, tbl, col FROM v_columns").toDF("database", "table", "column")


def tag_rows(t):
    return t("v_tags").toDF(*TAG_COLUMNS)


def rules(t):
    return policy.policy_tables(t.spark)


@check(f"SELECT {NAMED}, val AS value FROM expected", **POLICY)
def tag_expected(t):
    return tags.expected_tags(catalog(t), rules(t))


@check(f"SELECT {NAMED}, old, new FROM drift", **POLICY)
def tag_drift(t):
    return tags.tag_drift(tags.expected_tags(catalog(t), rules(t)), tag_rows(t))


@check("""SELECT tag, count(*) AS drifts, count(*) FILTER (WHERE old IS NULL) AS missing
    FROM drift GROUP BY tag""", **POLICY)
def tag_drift_summary(t):
    return tags.drift_summary(tags.tag_drift(tags.expected_tags(catalog(t), rules(t)), tag_rows(t)))


@check(f"""
    SELECT {NAMED}, val AS value FROM expected
    UNION ALL
    SELECT {NAMED}, val AS value FROM v_tags t WHERE NOT EXISTS (
      SELECT 1 FROM expected e WHERE e.db = t.db AND e.tbl = t.tbl AND e.col = t.col AND e.tag = t.tag)""",
       **POLICY)
def tag_reconciled(t):
    return reconcile_tags(catalog(t), rules(t), tag_rows(t)).tags


@check("""SELECT db AS "database", tbl AS "table" FROM p_table
    WHERE (db, tbl) NOT IN (SELECT db, tbl FROM known)""", **POLICY)
def tag_missing_tables(t):
    return tags.missing_tables(catalog(t), rules(t))


@check(f"""SELECT {NAMED}, val AS value FROM v_tags
    WHERE (tag, val) NOT IN (VALUES {values(TAXONOMY_ROWS)})""")
def tag_violations(t):
    return tags.validate_tags(tag_rows(t), rules(t).taxonomy)


@check("""
    SELECT db AS "database", tbl AS "table", col AS "column", 'PII' AS tag, 'direct' AS value FROM v_columns
      WHERE kind IS NOT NULL
    UNION ALL
    SELECT db, tbl, col, tag, val FROM v_tags
      WHERE tag <> 'PII' OR col IN (SELECT col FROM v_columns WHERE kind IS NULL)""".replace(
    "kind", f"({name_kind_sql('col')})"))
def pii_tagged(t):
    found = pii.pii_by_name(catalog(t)).select(
        "database", "table", "column", F.lit("PII").alias("tag"), F.col("pii").alias("value"))
    return upsert(tag_rows(t), found, tags.TAG_KEY, ["value"], TAG_COLUMNS)


@check("""SELECT db AS "database", tbl AS "table", col AS "column", tag, val AS value FROM v_tags""")
def tag_first_values(t):
    assigned = tag_rows(t).select(
        "database", "table", F.when(F.col("column") != "", F.col("column")).alias("column"), "tag",
        F.array("value", F.lit("other")).alias("values"))
    return tags.current_tags(assigned)


GRANTS = policy.FINANCE_GRANT + [
    ("ops_read", "operator", "SELECT", "BU", "operations"),
    ("ops_read", "operator", "SELECT", "Sensitivity", "restricted"),
    ("ops_describe", "operator", "DESCRIBE", "Sensitivity", "confidential"),
    ("shared", "finance_analyst", "SELECT,DESCRIBE", "BU", "analytics"),
    ("shared", "finance_analyst", "SELECT,DESCRIBE", "BU", "finance"),
    ("shared", "finance_analyst", "SELECT,DESCRIBE", "Sensitivity", "public"),
]


@check("""
    SELECT DISTINCT principal, permissions, db AS "database", tbl AS "table" FROM (
        SELECT g.grant_id, principal, permissions, db, tbl, count(DISTINCT g.key) AS held FROM grants g
          JOIN v_tags t ON t.col = '' AND t.tag = g.key AND t.val = g.value GROUP BY ALL) h
      JOIN (SELECT grant_id, count(DISTINCT key) AS needed FROM grants GROUP BY grant_id) n
        ON h.grant_id = n.grant_id AND held = needed""",
       grants=f"SELECT * FROM (VALUES {values(GRANTS)}) x(grant_id, principal, permissions, key, value)")
def tbac_tables(t):
    return tags.authorized_tables(tag_rows(t), policy.grants(t.spark, GRANTS))


# --- access, lint, audit ----------------------------------------------------

@check("SELECT transaction_id, customer_id, amount, region_code FROM v_txn WHERE region_code = 'APAC'")
def access_apac(t):
    return access.access_for(t("v_txn"), "apac_analyst").select(
        "transaction_id", "customer_id", "amount", "region_code")


@check("""SELECT customer_key, customer_id, first_name, last_name, email, country, region_code, start_date,
    end_date, is_current FROM v_dim""")
def access_marketing(t):
    return access.access_for(t("v_dim"), "marketing_analyst")


@check("""SELECT customer_id, sha256(ssn) AS ssn, CAST(NULL AS VARCHAR) AS phone_number,
    regexp_replace(regexp_replace(regexp_replace(email, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g')
      AS email FROM v_customers""")
def mask_columns(t):
    shown = t("v_customers").select("customer_id", "ssn", "phone_number", "email")
    return access.mask(shown, {"ssn": "sha2", "phone_number": "null", "email": "redact"})


LINTED = " UNION ALL ".join(
    f"SELECT event_id, '{code}' AS code, '{name}' AS rule, '{severity}' AS severity, '{text}' AS description "
    f"FROM log WHERE {condition}"
    for (code, (name, severity, text)), condition in zip(
        [(c, tuple(x.replace("'", "''") for x in r)) for c, r in lint.RULES.items()],
        [r"regexp_matches(s, 'select\s+\*\s+') OR regexp_matches(s, 'select\s+\w+\.\*\s+')",
         "contains(s, 'transactions') AND NOT contains(s, 'event_date') AND NOT contains(s, 'transaction_time')",
         "contains(s, 'customers') AND NOT contains(s, 'region_code') AND NOT contains(s, 'country')"]))
LOG = "SELECT event_id, lower(trim(sql_text)) s FROM v_query_log"


@check(LINTED, log=LOG)
def lint_queries(t):
    return lint.lint_queries(t("v_query_log").select("event_id", "sql_text")).drop("sql_text")


@check(f"SELECT code, severity, count(*) AS queries FROM ({LINTED}) GROUP BY code, severity", log=LOG)
def lint_summary(t):
    return lint.lint_summary(lint.lint_queries(t("v_query_log").select("event_id", "sql_text")))


def audit_log(t):
    return t("v_query_log").select(
        "event_id", F.struct(F.col("user_arn").alias("arn")).alias("user_identity"), "event_time", "event_name",
        "workgroup", F.struct(F.col("sql_text").alias("query")).alias("request_parameters"),
        "additional_event_data")


BYTES = "CAST(json_extract_string(additional_event_data, '$.bytesScanned') AS DOUBLE)"


@check(f"""SELECT event_id, user_arn, event_time, sql_text, {BYTES} / 1e9 AS scanned_gb FROM v_query_log
    WHERE event_name = 'StartQueryExecution' AND {BYTES} > 1e11
    ORDER BY scanned_gb DESC, event_id LIMIT 50""")
def expensive_queries(t):
    return audit.expensive_queries(audit_log(t), tie_break=["event_id"])


@check(f"""SELECT event_id, workgroup, {BYTES} AS scanned_bytes, cap_bytes FROM v_query_log
    JOIN (VALUES ('marketing_workgroup', 10737418240), ('finance_workgroup', 107374182400)) c(wg, cap_bytes)
      ON workgroup = wg
    WHERE event_name = 'StartQueryExecution' AND {BYTES} > cap_bytes""")
def budget_breaches(t):
    return audit.budget_breaches(audit_log(t)).select("event_id", "workgroup", "scanned_bytes", "cap_bytes")


@check("""SELECT table_name, last_updated_time FROM (
      SELECT concat('t_', CAST(user_id AS VARCHAR)) AS table_name, max(ts) AS last_updated_time
      FROM events GROUP BY user_id)
    WHERE last_updated_time < DATE '2024-04-29' - INTERVAL 90 DAY""")
def stale_tables(t):
    inventory = t("events").groupBy(F.concat(F.lit("t_"), "user_id").alias("table_name")).agg(
        F.max("ts").alias("last_updated_time"))
    return audit.stale_tables(inventory, "2024-04-29")


@check("""SELECT zone, user_arn, event_name, strftime(event_time, '%Y-%m-%d') AS event_day, count(*) AS events
    FROM v_query_log GROUP BY ALL""")
def access_summary(t):
    return audit.access_summary(t("v_query_log")).withColumn("event_day", F.col("event_day").cast("string"))


@check(f"""
    SELECT {NAMED}, val AS value FROM v_tags
    UNION ALL
    SELECT 'conformed_db', 'people', "column", 'PII', pii FROM ({detected_sql(profile_sql(CUSTOMER, "v_customers"))})""")
def pii_scanned(t):
    people = {("conformed_db", "people"): lambda: t("v_customers").select(*CUSTOMER),
              ("conformed_db", "lines"): lambda: t("lineitem")}
    return pii_scan(t.spark, people, tag_rows(t))


@check(f"""SELECT user_arn, event_time, sql_text, {BYTES} / 1e9 AS scanned_gb FROM v_query_log
    WHERE event_name = 'StartQueryExecution' AND {BYTES} > 1e11
    ORDER BY scanned_gb DESC, event_time, user_arn, sql_text LIMIT 50""")
def audit_from_json(t):
    root = new_path(t.spark, "audit")
    audit_log(t).write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(root)
    found = audit.expensive_queries(read_audit_log(t.spark, root))
    return found.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


@check("""SELECT zone, user_arn, event_name, strftime(event_time, '%Y-%m-%d') AS event_day, count(*) AS events
    FROM v_query_log WHERE zone <> 'raw' OR event_id % 3 <> 0 GROUP BY ALL""")
def access_from_json(t):
    """Data events written as audit records; a third of the raw ones concern a bucket of no zone."""
    root = new_path(t.spark, "events")
    bucket = F.when((F.col("zone") == "raw") & (F.col("event_id") % 3 == 0), "rawhide").otherwise(
        F.concat(F.lit("lake-"), "zone", F.lit("-7")))
    t("v_query_log").select(
        F.struct(F.col("user_arn").alias("arn")).alias("user_identity"), "event_time", "event_name",
        F.struct(bucket.alias("bucketName"), F.lit("k").alias("key")).alias("request_parameters"),
    ).write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(root)
    found = audit.zone_access(read_audit_log(t.spark, root))
    return found.withColumn("event_day", F.col("event_day").cast("string"))


RAW_PII = f"""
    SELECT {NAMED}, val AS value FROM v_tags
    UNION ALL
    SELECT 'raw_db', 'people', "column", 'PII', pii FROM ({detected_sql(profile_sql(CUSTOMER, "v_customers"))})"""


@check(RAW_PII)
def pii_raw_csv(t):
    root = new_path(t.spark, "raw") + "/people"
    # Several files, each with a header of its own order.
    for part, header in enumerate([CUSTOMER, CUSTOMER[::-1]]):
        t("v_customers").where(F.col("c_custkey") % 2 == part).select(*header).write.option(
            "header", "true").csv(f"{root}/part={part}")
    return pii_scan_raw(t.spark, [root], "raw_db", tag_rows(t))


@check(RAW_PII)
def pii_raw_json(t):
    root = new_path(t.spark, "raw") + "/people"
    t("v_customers").select(*CUSTOMER).write.json(root)
    return pii_scan_raw(t.spark, [root], "raw_db", tag_rows(t))


def mixed_folder(t):
    """Customers as .csv, .CSV and .json files in one folder, some lines unfit, and a file that is neither."""
    root = new_path(t.spark, "raw") + "/people"
    people = t("v_customers")
    odd = F.when(F.col("c_custkey") % 5 == 0, F.concat_ws(",", "last_name", "ssn")).otherwise(F.col("last_name"))
    for part, ending in ((1, ".csv"), (2, ".CSV")):
        lines = people.where(F.col("c_custkey") % 3 == part).select(
            F.concat_ws(",", "customer_id", "email", odd).alias("value"))
        head = t.spark.createDataFrame([("who,contact,family",)], "value string")
        # One file: the header is its first line.
        write_lines(head.unionByName(lines), f"{root}/part={part}", ending)
    record = F.to_json(F.struct(F.col("customer_id").alias("who"), F.col("ssn").alias("paper"), "phone_number"))
    cut = F.when(F.col("c_custkey") % 7 == 0, F.concat(F.lit('{"who": '), "ssn")).otherwise(record)
    write_lines(people.where(F.col("c_custkey") % 3 == 0).select(cut.alias("value")), f"{root}/part=0", ".json")
    write_lines(people.select("email"), f"{root}/part=9", ".txt")
    return root


def write_lines(lines, folder, ending):
    """Text files whose names have an ending of the caller's choice."""
    lines.coalesce(1).write.text(folder)
    if ending == ".txt":
        return
    move = Folder(lines.sparkSession, folder)
    for path in [r["path"] for r in file_inventory(lines.sparkSession, folder).select("path").collect()]:
        move.move(path, path.removesuffix(".txt") + ending)


@check(f"""
    SELECT {NAMED}, val AS value FROM v_tags
    UNION ALL
    SELECT 'raw_db', 'people', c, 'PII', 'direct' FROM (VALUES ('contact'), ('paper'), ('phone_number')) x(c)""")
def pii_raw_mixed(t):
    return pii_scan_raw(t.spark, [mixed_folder(t)], "raw_db", tag_rows(t))


@check("""SELECT 'people' AS "table", kind, files, rejected, ssn_hits FROM (
    SELECT 'csv' AS kind, 2 AS files, count(*) AS rejected, count(*) AS ssn_hits FROM v_customers
        WHERE c_custkey % 3 <> 0 AND c_custkey % 5 = 0
    UNION ALL SELECT 'json', 1, count(*), count(*) FROM v_customers WHERE c_custkey % 3 = 0 AND c_custkey % 7 = 0
    UNION ALL SELECT 'other', 1, 0, 0)""")
def pii_raw_rejected(t):
    """How many lines fitted nowhere, and how many of them hold a number like an SSN."""
    found = scan_raw_folders(t.spark, [mixed_folder(t)], "raw_db", tag_rows(t))
    return found.report.select("table", "kind", "files", "rejected", "ssn_hits")


# A table flows into the next one of the following database, column by column.
FLOWS = """SELECT a.db AS from_database, a.tbl AS from_table, a.col AS from_column, b.db AS database, b.tbl AS "table", b.col AS "column"
    FROM v_columns a JOIN v_columns b ON b.o_orderkey = a.o_orderkey + 9 WHERE a.db <> 'scratch_db'"""
RANK = "CASE val WHEN 'none' THEN 0 WHEN 'quasi' THEN 1 WHEN 'direct' THEN 2 END"


@check(f"""SELECT d AS database, t AS "table", c AS "column", value, CASE r WHEN 1 THEN 'quasi' ELSE 'direct' END AS inherited FROM (
      SELECT o.d, o.t, o.c, min(own.val) AS value, max(o.r) AS r, max(coalesce({RANK.replace("val", "own.val")}, 0)) AS now FROM (
        SELECT p.d, p.t, p.c, {RANK} AS r FROM paths p JOIN v_tags s ON s.db = p.fd AND s.tbl = p.ft AND s.col = p.fc AND s.tag = 'PII') o
      LEFT JOIN v_tags own ON own.db = o.d AND own.tbl = o.t AND own.col = o.c AND own.tag = 'PII' GROUP BY o.d, o.t, o.c)
    WHERE r > now""",
       flows=FLOWS.replace('"table"', '"to_table"').replace('"column"', '"to_column"'),
       one="SELECT from_database AS fd, from_table AS ft, from_column AS fc, database AS d, to_table AS t, to_column AS c FROM flows",
       two="SELECT a.fd, a.ft, a.fc, b.d, b.t, b.c FROM one a JOIN one b ON a.d = b.fd AND a.t = b.ft AND a.c = b.fc",
       three="SELECT a.fd, a.ft, a.fc, b.d, b.t, b.c FROM two a JOIN one b ON a.d = b.fd AND a.t = b.ft AND a.c = b.fc",
       paths="SELECT * FROM one UNION SELECT * FROM two UNION SELECT * FROM three")
def tag_lineage(t):
    """Columns tagged less strictly than a column they are made from, over up to three tables."""
    a, b = (t("v_columns").select(*[F.col(c).alias(f"{k}_{c}") for c in ("db", "tbl", "col", "o_orderkey")]) for k in "ab")
    flows = a.join(b, F.col("b_o_orderkey") == F.col("a_o_orderkey") + 9).where("a_db <> 'scratch_db'").select(
        F.col("a_db").alias("from_database"), F.col("a_tbl").alias("from_table"), F.col("a_col").alias("from_column"),
        F.col("b_db").alias("database"), F.col("b_tbl").alias("table"), F.col("b_col").alias("column"))
    return lineage.weaker_than_source(tag_rows(t), flows)
