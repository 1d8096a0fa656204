from lipiflow.operators import rolls
from lipiflow.schemas import VOTER_COLUMNS


def voters(spark, *texts, **how):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "page int, text string")
    return rolls.voters(df, "text", "page", **how)


def test_greedy_house(spark):
    r = voters(spark, "1 अमर कमल पु 45").first()
    assert (r.srNo, r.houseNo, r.voterNameHindi, r.fatherOrHusbandNameHindi, r.gender, r.age) == ("1", "अ", "मर", "कमल", "M", 45)


def test_ages_and_genders(spark):
    texts = [f"1 अमर नयन कमल {g} {a}" for g, a in (("पु", 17), ("पु", 18), ("फ", 120), ("म", 121), ("स्त्री", 60))]
    assert sorted((r.page, r.age, r.gender) for r in voters(spark, *texts).collect()) == [(1, 18, "M"), (2, 120, "F"), (4, 60, "F")]


def test_vowel_signs_need_the_extended_pattern(spark):
    line = "49 सीता देवी मोहन लाल पु 46"
    assert voters(spark, line).count() == 0
    assert voters(spark, line, extended=True).count() == 1
    assert voters(spark, None, "", "short").count() == 0


def test_header_and_columns(spark):
    r = voters(spark, "अनुभाग:12 ; भाग:3 ; कक्ष 7 ; 12 अमर नयन कमल पु 45").first()
    assert (r.sectionNumber, r.partNumber, r.roomNumber, r.ward) == ("12", "12", "7", "UNKNOWN-ward")
    from pyspark.sql import functions as F

    rows = rolls.voter_rows(voters(spark, "12 अमर नयन कमल पु 45"), F.lit("a.pdf"))
    assert tuple(rows.columns) == VOTER_COLUMNS and rows.first().sourceFile == "a.pdf"


def test_first_of_equal_voters_stays(spark):
    df = voters(spark, "12 अमर नयन कमल पु 45", "12 अमर नयन कमल पु 46").withColumnRenamed("page", "doc")
    from pyspark.sql import functions as F

    kept = rolls.unique_voters(df.withColumn("file", F.lit("f")), "file", "doc", "_seq").collect()
    assert [r.age for r in kept] == [45]
