"""Resource bundles: conversations stand for pages of entries, customers for patients."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.operators.bundles import explode_entries, reconcile_totals
from obsflow.plans.clinical import bundle_balance, patient_to_silver, raw_to_bronze, raw_to_whole_bronze
from obsflow.registry.inputs import table
from obsflow.schemas import SEARCH
from obsflow.session import work_folder
from obsflow.sinks.files import as_columnar, land_documents
from obsflow.sources.documents import read_bundles
from obsflow.sources.tables import layer_path, read_layer

TURN = T.StructType([T.StructField(name, T.StringType()) for name in ("id", "role", "text")])
ENTRY = T.StructType([T.StructField("resource", TURN), T.StructField("search", SEARCH)])
PATIENTS_PER_PAGE = 50


def _bundle_pages(spark: SparkSession, sf_dir: str, turns: int) -> DataFrame:
    """Conversations cut into pages of so many turns, in order of turn."""
    entry = F.struct(
        F.col("turn"),
        F.struct(
            F.concat_ws("-", "conv_id", "turn").alias("id"), F.col("role"), F.col("text")
        ).alias("resource"),
        F.struct(F.lit("match").alias("mode")).alias("search"),
    )
    gathered = (
        table(spark, sf_dir, "conversations")
        .groupBy("conv_id", F.expr(f"turn DIV {turns}").alias("page"))
        .agg(F.sort_array(F.collect_list(entry)).alias("entry"))
    )
    declared = F.size("entry") + F.when(F.col("conv_id") % 3 == 0, 1).otherwise(0)
    return gathered.select(
        declared.cast("long").alias("total"),
        F.transform("entry", lambda e: F.struct(e["resource"], e["search"])).alias("entry"),
    )


def _landed_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short pages landed twice, long pages once and in the columnar layout."""
    folder = work_folder(spark, "bundles")
    short, long = (_bundle_pages(spark, sf_dir, turns) for turns in (4, 8))
    land_documents(short, folder)
    land_documents(short, folder)
    land_documents(as_columnar(long), folder)
    return read_bundles(spark, folder, ENTRY)


def _flat(entries: DataFrame) -> DataFrame:
    return entries.select("data.resource.*", "data.search.mode")


def page_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(explode_entries(_landed_bundles(spark, sf_dir), dedupe="page"))


def entry_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(explode_entries(_landed_bundles(spark, sf_dir), dedupe="entry"))


def all_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(explode_entries(_landed_bundles(spark, sf_dir), dedupe=None))


def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    bundles = _landed_bundles(spark, sf_dir)
    first_id = F.col("entry")[0][0]["resource"]["id"]
    labelled = bundles.withColumn("conv_id", F.split_part(first_id, F.lit("-"), F.lit(1)))
    return reconcile_totals(labelled, ["conv_id"])


# Columns of a patient behind the id, as JSON of the declared fields and of all that landed.
NESTED = {
    "name": ('[{"family":"%s","given":["%s"]}]', '[{"family":"%s","given":["%s"],"period":{"start":"2001"}}]', ("c_name", "c_mktsegment")),
    "address": ('[{"city":"City %s"}]', '[{"city":"City %s","district":"x"}]', ("c_custkey % 20",)),
    "careProvider": ('[{"reference":"Practitioner/%s"}]', '[{"reference":"Practitioner/%s"}]', ("c_nationkey",)),
    "identifier": ('[{"system":"urn:s","value":"%s"}]', '[{"system":"urn:s","value":"%s"}]', ("c_custkey",)),
    "managingOrganization": ('{"reference":"Organization/%s"}', '{"reference":"Organization/%s"}', ("c_nationkey % 3",)),
    "maritalStatus": ('{"coding":[{"code":"M"}],"text":"%s"}', '{"coding":[{"code":"M"}],"text":"%s"}', ("c_mktsegment",)),
    "meta": ('{"versionId":"%s"}', '{"tag":[{"code":"t"}],"versionId":"%s"}', ("c_custkey % 4",)),
    "telecom": ('[{"system":"phone","value":"%s"}]', '[{"rank":1,"system":"phone","value":"%s"}]', ("c_custkey",)),
    "search": ('{"mode":"match"}', '{"mode":"match","score":0.5}', ()),
}
PLAIN = {
    "active": "c_custkey % 2 = 0",
    "resourceType": "'Patient'",
    "gender": "CASE c_custkey % 3 WHEN 0 THEN 'female' WHEN 1 THEN 'male' END",
}


def _filled(text: str, columns: tuple[str, ...]) -> str:
    """SQL for a text with the values of columns in its gaps, in the wording of both engines."""
    parts = text.split("%s")
    out = [f"'{parts[0]}'"]
    for column, part in zip(columns, parts[1:]):
        out += [f"CAST({column} AS STRING)", f"'{part}'"]
    return " || ".join(out)


def _missing(name: str, sql: str) -> str:
    return f"CASE WHEN c_custkey % 5 <> 0 THEN {sql} END" if name == "address" else sql


def _landed_patients(spark: SparkSession, sf_dir: str) -> str:
    """Customers as patients in pages of two sizes. Pages overlap, so patients come more than once."""
    root = work_folder(spark, "lake")
    fields = ["""'"id":"' || CASE WHEN c_custkey % 11 = 0 THEN 'x' ELSE '' END || c_custkey || '"'"""]
    fields += [f"""'"{name}":' || CAST({sql} AS STRING)""" for name, sql in PLAIN.items() if name == "active"]
    fields += [f"""'"{name}":"' || ({sql}) || '"'""" for name, sql in PLAIN.items() if name != "active"]
    fields.append(
        """'"birthDate":"' || CASE WHEN c_custkey % 13 = 0 THEN 'unknown'
           ELSE date_format(date_add(DATE '1950-01-01', CAST(c_custkey % 20000 AS INT)), 'yyyy-MM-dd') END || '"'"""
    )
    fields += [f"""'"{name}":' || {_missing(name, _filled(whole, columns))}""" for name, (_, whole, columns) in NESTED.items() if name != "search"]
    # A field without a value is left out, as a service does.
    resource = f"concat_ws(',', {', '.join(fields)})"
    entry = F.expr(f"""concat('{{"fullUrl":"urn:', c_custkey, '","resource":{{', {resource}, '}},"search":{NESTED["search"][1]}}}')""")
    customers = table(spark, sf_dir, "customer")
    for width in (PATIENTS_PER_PAGE, 2 * PATIENTS_PER_PAGE):
        page = customers.groupBy(F.expr(f"c_custkey DIV {width}").alias("page")).agg(F.array_sort(F.collect_list(entry)).alias("entries"))
        line = F.concat(F.lit('{"total":'), F.size("entries"), F.lit(',"entry":['), F.concat_ws(",", "entries"), F.lit("]}"))
        page.select(line.alias("value")).write.mode("append").text(layer_path(root, "raw", "patient"))
    return root


def _silver(spark: SparkSession, root: str) -> DataFrame:
    """All columns; lists and objects as JSON."""
    silver = read_layer(spark, root, "silver", "patient")
    return silver.select(*[F.to_json(c).alias(c) if c in NESTED else F.col(c) for c in silver.columns])


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw to bronze to silver, by the declared schema."""
    root = _landed_patients(spark, sf_dir)
    raw_to_bronze(spark, root, ["patient"])
    patient_to_silver(spark, root)
    return _silver(spark, root)


def whole_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with entries kept whole: nested columns hold every field that landed."""
    root = _landed_patients(spark, sf_dir)
    raw_to_whole_bronze(spark, root, ["patient"])
    patient_to_silver(spark, root, nested="whole")
    return _silver(spark, root)


# An entry of a conversation, its fields in order of name.
_TURN_JSON = """'{"fullUrl":"urn:' || host || ':' || conv_id || '-' || turn || '"' ||
    CASE WHEN turn % 4 = 3 AND conv_id % 3 = 0 THEN '' ELSE ',"resource":{"id":"' || conv_id || '-' || turn
        || '","meta":{"tag":[{"code":"' || role || '"}]},"turn":' || turn || '}' END
    || ',"search":{"mode":"match","score":0.5}}'"""


def _landed_whole(spark: SparkSession, sf_dir: str) -> str:
    """Two runs of the same pages. In the second every fifth conversation comes from another host, which only ``fullUrl`` tells.

    Some entries have no resource, and of some conversations the documents are cut off.
    """
    root = work_folder(spark, "lake")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    for run, host in (("1", "'a'"), ("2", "CASE WHEN conv_id % 5 = 0 THEN 'b' ELSE 'a' END")):
        entry = F.struct("turn", F.expr(_TURN_JSON).alias("text"))
        pages = (
            turns.withColumn("host", F.expr(host))
            .groupBy("conv_id", F.expr("turn DIV 4").alias("page"))
            .agg(F.sort_array(F.collect_list(entry))["text"].alias("entries"))
        )
        line = F.concat(F.lit('{"total":'), F.size("entries"), F.lit(',"entry":['), F.concat_ws(",", "entries"), F.lit("]}"))
        cut = F.when(F.col("conv_id") % 7 == 3, F.substring(line, 1, 60)).otherwise(line)
        pages.select(cut.alias("value")).write.text(f"{layer_path(root, 'raw', 'turn')}/run={run}")
    raw_to_whole_bronze(spark, root, ["turn"])
    return root


def whole_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries as they landed, undeclared fields included."""
    bronze = read_layer(spark, _landed_whole(spark, sf_dir), "bronze", "turn")
    return bronze.select(F.to_json("data").alias("data"), "position")


def whole_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per landed run: what became of its entries, and whether nothing was lost."""
    files = bundle_balance(spark, _landed_whole(spark, sf_dir), "turn")
    counts = [F.sum(c).alias(c) for c in ("landed", "bronze", "rejected", "removed")]
    run = F.regexp_extract("source_file", "run=([0-9]+)", 1).alias("run")
    return files.groupBy(run).agg(*counts, F.bool_and("balanced").alias("balanced"))


def whole_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything unusable, with its text and a reason."""
    rejects = read_layer(spark, _landed_whole(spark, sf_dir), "rejected", "turn")
    return rejects.select(F.regexp_extract("source_file", "run=([0-9]+)", 1).alias("run"), "reason", "text")


QUERIES = {
    "bundle_page_distinct": page_distinct,
    "bundle_entry_distinct": entry_distinct,
    "bundle_all_entries": all_entries,
    "reconcile_totals": reconcile,
    "patient_silver": patients,
    "patient_silver_whole": whole_patients,
    "bundle_whole_bronze": whole_bronze,
    "bundle_whole_rejects": whole_rejects,
    "bundle_balance": whole_balance,
}


def _pages_sql(turns: int) -> str:
    return f"""SELECT list({{'id': conv_id || '-' || turn, 'role': role, 'text': text}}
                    ORDER BY turn) AS page
    FROM conversations GROUP BY conv_id, turn // {turns}"""


_RUNS_SQL = f"""turns AS (
    SELECT conv_id, turn, role, run, CASE WHEN run = '2' AND conv_id % 5 = 0 THEN 'b' ELSE 'a' END AS host
    FROM conversations, (VALUES ('1'), ('2')) AS runs(run)
), entries AS (
    SELECT *, {_TURN_JSON} AS entry, conv_id % 7 <> 3 AS whole, NOT (turn % 4 = 3 AND conv_id % 3 = 0) AS usable FROM turns
), pages AS (
    SELECT run, conv_id, turn // 4 AS page, whole, count(*) AS n,
           '{{"total":' || count(*) || ',"entry":[' || string_agg(entry, ',' ORDER BY turn) || ']}}' AS line
    FROM entries GROUP BY ALL
)"""


def _silver_sql(whole: bool) -> str:
    nested = [f"{_missing(name, _filled(texts[whole], columns))} AS {name}" for name, (*texts, columns) in NESTED.items()]
    plain = [f"{sql} AS {name}" for name, sql in PLAIN.items()]
    return f"""
SELECT CASE WHEN c_custkey % 11 <> 0 THEN c_custkey END AS id,
       CASE WHEN c_custkey % 13 <> 0 THEN strftime(
           DATE '1950-01-01' + CAST(c_custkey % 20000 AS INTEGER), '%Y-%m-%d') END AS birthdate,
       {", ".join(plain + nested)}
FROM customer"""


ORACLES = {
    "bundle_page_distinct": f"""
WITH pages AS ({_pages_sql(4)} UNION {_pages_sql(8)}),
entries AS (SELECT unnest(page) AS e FROM pages)
SELECT e.id AS id, e.role AS role, e.text AS text, 'match' AS mode FROM entries""",
    "bundle_entry_distinct": """
SELECT DISTINCT conv_id || '-' || turn AS id, role, text, 'match' AS mode FROM conversations""",
    "bundle_all_entries": """
SELECT conv_id || '-' || turn AS id, role, text, 'match' AS mode
FROM conversations, (VALUES (1), (2), (3)) AS copies(n)""",
    "reconcile_totals": """
WITH sizes AS (
    SELECT conv_id, 2 * count(*) AS n, 2 AS copies FROM conversations GROUP BY conv_id, turn // 4
    UNION ALL
    SELECT conv_id, count(*), 1 FROM conversations GROUP BY conv_id, turn // 8
)
SELECT CAST(conv_id AS VARCHAR) AS conv_id,
       CAST(sum(n + CASE WHEN conv_id % 3 = 0 THEN copies ELSE 0 END) AS BIGINT) AS declared,
       CAST(sum(n) AS BIGINT) AS extracted,
       CAST(sum(CASE WHEN conv_id % 3 = 0 THEN copies ELSE 0 END) AS BIGINT) AS missing
FROM sizes GROUP BY conv_id""",
    "patient_silver": _silver_sql(whole=False),
    "patient_silver_whole": _silver_sql(whole=True),
    "bundle_whole_bronze": f"""
WITH {_RUNS_SQL}
SELECT DISTINCT entry AS data, turn % 4 AS position FROM entries WHERE whole AND usable""",
    "bundle_whole_rejects": f"""
WITH {_RUNS_SQL}, firsts AS (
    SELECT entry, min(run) AS run FROM entries WHERE whole AND NOT usable GROUP BY entry
)
SELECT run, 'no resource' AS reason, entry AS text FROM firsts
UNION ALL
SELECT run, 'broken document', substr(line, 1, 60) FROM pages WHERE NOT whole""",
    "bundle_balance": f"""
WITH {_RUNS_SQL}, again AS (
    SELECT run, sum(n) AS removed FROM pages WHERE whole AND run = '2' AND conv_id % 5 <> 0 GROUP BY run
), counted AS (
    SELECT run, CAST(sum(CASE WHEN whole THEN n ELSE 1 END) AS BIGINT) AS landed FROM pages GROUP BY run
), bad AS (
    SELECT run, count(*) AS rejected FROM (
        SELECT run FROM entries WHERE whole AND NOT usable AND (run = '1' OR conv_id % 5 = 0)
        UNION ALL SELECT run FROM pages WHERE NOT whole) GROUP BY run
)
SELECT run, landed, CAST(landed - coalesce(rejected, 0) - coalesce(removed, 0) AS BIGINT) AS bronze,
       CAST(coalesce(rejected, 0) AS BIGINT) AS rejected, CAST(coalesce(removed, 0) AS BIGINT) AS removed, true AS balanced
FROM counted LEFT JOIN bad USING (run) LEFT JOIN again USING (run)""",
}
