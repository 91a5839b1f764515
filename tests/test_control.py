from gridloom.sources import control


def tables(spark):
    details = spark.createDataFrame(
        [(1, 10, " 0.5 "), (1, 11, "  "), (1, 12, "l2"), (2, 10, "9")],
        "MODEL_ID int, KEY_ID int, KEY_VALUE string")
    names = spark.createDataFrame([(10, " Step "), (11, "ratio"), (12, "RegType")], "ID int, KEY_NAME string")
    jobs = spark.createDataFrame([(1, "u1", "1"), (2, "u2", "7")], "ID int, UUID string, AL_ID string")
    return details, names, jobs


def test_parameters_are_lowered_trimmed_and_not_empty(spark):
    assert control.job_parameters(*tables(spark), "u1") == {"step": "0.5", "regtype": "l2"}


def test_a_comma_list_looks_up_its_first_job(spark):
    assert control.job_parameters(*tables(spark), "u2,u1") == {"step": "9"}


def test_algorithm_and_dictionary_lookups(spark):
    assert control.algorithm_id(tables(spark)[2], "u2") == "7"
    assert control.algorithm_id(tables(spark)[2], "none") == ""
    dictionary = spark.createDataFrame(
        [("DAO_API", "DAO_API_SCHEMA", "db")], "PARENT_DIC_TYPE string, DIC_NAME string, dic_value string")
    assert control.dictionary_value(dictionary, "DAO_API", "DAO_API_SCHEMA") == "db"
    assert control.dictionary_value(dictionary, "DAO_API", "x") == ""


def test_scoring_job_drops_blank_cells(spark):
    table = spark.createDataFrame(
        [("s1", " select 1 ", "u1", "  ", "out")],
        "uuid string, select_table string, model_uuid string, output_param string, output_table string")
    assert control.scoring_job(table, "s1,s2") == {"sql": "select 1", "muuid": "u1", "tablename": "out"}
    assert control.scoring_job(table, "zz") == {}


def test_newest_path_counts_numbers_not_text(spark):
    paths = spark.createDataFrame(
        [("j", "a", "/old", "999"), ("j", "a", "/new", "1000"), ("k", "a", "/k", "5")],
        "jobId string, appName string, savePath string, timestamp string")
    assert control.model_path(paths, "j") == "/new"
    assert control.model_path(paths, "none") == ""


def test_control_characters_are_trimmed(spark):
    rows = spark.createDataFrame([("j", "Step\n", "\t0.5\x01 "), ("j", "empty", "\n")],
                                 "uuid string, key_name string, key_value string")
    assert [tuple(r) for r in control.clean_parameters(rows).collect()] == [("j", "step", "0.5")]
