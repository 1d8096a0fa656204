"""A small Devanagari corpus built from ``customer``, the same in Spark and in DuckDB.

The given tables hold no Devanagari, so queries over text operators run on this.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lipiflow.plans.parts import parts

FIRST = ("राम", "सीता", "गीता", "मोहन", "राधा", "श्याम", "कृष्ण", "प्रिया", "अनिल", "सुनील")
LAST = ("शर्मा", "पटेल", "कुमार", "देवी", "गुप्ता", "यादव", "सिंह")
# Names without vowel signs, which the roll patterns can match.
PLAIN_FIRST = ("अमर", "कमल", "रमन", "भरत", "मदन")
PLAIN_LAST = ("कमल", "रमन", "नयन", "जगत", "पवन", "अजय")


def _pick(values: tuple[str, ...], key: str, spark: bool) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({listed}), cast({key} % {len(values)} as int) + 1)" if spark else f"([{listed}])[cast({key} % {len(values)} as int) + 1]"


def corpus_sql(spark: bool = False) -> str:
    first, last = _pick(FIRST, "c_custkey", spark), _pick(LAST, "c_custkey", spark)
    date = "lpad(cast(1 + c_custkey % 28 as varchar(9)), 2, '0') || '/' || lpad(cast(1 + c_custkey % 12 as varchar(9)), 2, '0') || '/19' || cast(50 + c_custkey % 50 as varchar(9))"
    return f"""
    SELECT c_custkey AS doc_id, c_nationkey AS file_no, cast(1 + c_custkey % 3 as int) AS page_number,
      CASE c_custkey % 12
        WHEN 0 THEN NULL
        WHEN 1 THEN ''
        WHEN 2 THEN '!!! ' || f || '  ###  ' || l || ' $$$ '
        WHEN 3 THEN 'श्रीमती ' || f
        WHEN 4 THEN f || ' । । ' || l || ' ।।। 12'
        WHEN 5 THEN f || ' ' || l || ' ' || f || ' ' || l || ' ' || f
        WHEN 6 THEN 'क ख - ' || f || ' ' || l || ' - ' || f || ' ' || l
        ELSE 'नाम: ' || f || ' ' || l || ' आयु: ' || cast(18 + c_custkey % 70 as varchar(9)) || ' वर्ष जन्म: ' || {date} || ' !@# पता: दिल्ली, भारत'
      END AS text
    FROM (SELECT c_custkey, c_nationkey, {first} AS f, {last} AS l FROM customer) AS named"""


def rolls_sql(spark: bool = False) -> str:
    """Pages of a roll: a header and one to three voters, some under age, some twice, one with a broken font."""
    first, last, other = _pick(PLAIN_FIRST, "c_custkey", spark), _pick(PLAIN_LAST, "c_custkey", spark), _pick(PLAIN_FIRST, "(c_custkey + 1)", spark)
    key = lambda e: f"cast({e} as varchar(9))"
    return f"""
    SELECT c_custkey AS doc_id, c_nationkey AS file_no,
      CASE c_custkey % 5
        WHEN 0 THEN NULL
        WHEN 1 THEN 'अनुभाग: ' || {key('c_custkey % 9 + 1')} || ' ; ' || {key('c_custkey % 90 + 10')} || ' ' || CASE WHEN c_custkey % 2 = 0 THEN f ELSE f || ' ' || l END || ' पु ' || {key('15 + c_custkey % 110')}
        WHEN 2 THEN 'कक्ष: 7 ; ' || {key('c_custkey % 40 + 10')} || ' A12 ' || f || ' ' || o || ' ' || l || ' पु ' || {key('20 + c_custkey % 60')} || ' ; ' || {key('c_custkey % 40 + 11')} || ' B7 ' || o || ' ' || f || ' ' || l || ' म ' || {key('30 + c_custkey % 60')}
        WHEN 3 THEN '(cid:147)(cid:152)(cid:155)(cid:9) ; ' || {key('c_custkey % 40 + 10')} || ' ' || f || ' ' || o || ' ' || l || ' फ ' || {key('25 + c_custkey % 60')}
        ELSE 'नगर: ' || f || ' ; भाग: ' || {key('c_custkey % 7')} || chr(10) || {key('c_custkey % 3 + 10')} || ' ' || f || ' ' || f || ' ' || l || ' पु 45'
      END AS text
    FROM (SELECT c_custkey, c_nationkey, {first} AS f, {last} AS l, {other} AS o FROM customer) AS named"""


def _run(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    # Keys are narrow and pages dear, so a file that is read by one task is dealt to all before pages are made.
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_nationkey")
    customers = customers.repartition(parts(spark), "c_custkey")
    return spark.sql(sql.replace("FROM customer", "FROM {customer}").replace("{customer}", "{c}"), c=customers)


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, corpus_sql(True)).withColumn("file_id", F.col("file_no").cast("string"))


def rolls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, rolls_sql(True)).withColumn("file_id", F.col("file_no").cast("string"))
