"""Physical-plan text for assertions (metadata not truncated)."""


def plan_text(df) -> str:
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        jvm = df.sparkSession.sparkContext._jvm
        return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
