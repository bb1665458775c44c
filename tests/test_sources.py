import os

import pytest
from pyspark.sql import functions as F

from curbsight.operators import audit, documents
from curbsight.plans.queries import QUERIES
from curbsight.sources import adapters, csv_files, jdbc, storage, tables, vectors
from curbsight.streaming import silver_stream
from tests.helpers import plan, rows, values

TICKET = (1, "CUST_00001", "home", "basic", 'a"q,b', "line1\nline2", "back\\slash", "sad", "bug", 3, 1.5)


def test_ticket_csv_keeps_quotes_commas_lines_and_backslashes(spark, folder):
    df = spark.createDataFrame([TICKET, (2, *[None] * 10)], csv_files.TICKET_SCHEMA)
    csv_files.write_tickets(df, folder)
    back = csv_files.read_tickets(spark, folder)
    assert back.schema == csv_files.TICKET_SCHEMA
    assert sorted(rows(back)) == sorted(rows(df))


def test_empty_text_comes_back_null_and_null_words_are_opt_in(spark, folder):
    texts = ["", None, "NA", "None", "x"]
    df = spark.createDataFrame([(str(i), t, t, t, t, t) for i, t in enumerate(texts)], csv_files.RAG_SCHEMA)
    csv_files.export_rag(df, folder)
    plain = csv_files.read_rag(spark, folder, ["property_id", "resolution_notes"])
    assert dict(rows(plain)) == {"0": None, "1": None, "2": "NA", "3": "None", "4": "x"}
    strict = csv_files.read_rag(spark, folder, ["property_id", "resolution_notes"], null_words=["NA", "None"])
    assert dict(rows(strict)) == {"0": None, "1": None, "2": None, "3": None, "4": "x"}


def test_pruned_csv_read_parses_two_columns(spark, folder):
    csv_files.export_rag(spark.createDataFrame([("a",) * 6], csv_files.RAG_SCHEMA), folder)
    text = plan(csv_files.read_rag(spark, folder, ["property_id", "service_category"]))
    assert "ReadSchema: struct<property_id:string,service_category:string>" in text


def test_missing_export_raises(spark, folder):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        csv_files.read_rag(spark, folder + "/nowhere")


def test_export_splits_large_outputs(spark, tmp_path):
    df = spark.createDataFrame([("a",) * 6] * 25, csv_files.RAG_SCHEMA).coalesce(1)
    csv_files.export_rag(df, str(tmp_path / "many"), rows_per_file=10)
    csv_files.export_rag(df.repartition(4), str(tmp_path / "one"), single_file=True)
    assert len(list((tmp_path / "many").glob("*.csv"))) == 3
    assert len(list((tmp_path / "one").glob("*.csv"))) == 1


def test_file_order_is_kept(spark, folder):
    df = spark.createDataFrame([(f"{i:03}",) * 6 for i in range(100)], csv_files.RAG_SCHEMA).coalesce(1)
    csv_files.export_rag(df, folder, rows_per_file=30)
    back = csv_files.read_rag_in_order(spark, folder)
    assert values(back.orderBy("ingest_order"), "property_id") == [f"{i:03}" for i in range(100)]


def test_tables_can_change_schema(spark, folder):
    tables.write_table(spark.range(3).toDF("a"), "changing", folder + "/one")
    tables.write_table(spark.range(2).selectExpr("id AS b", "'x' AS c"), "changing", folder + "/two")
    assert tables.read_table(spark, "changing").columns == ["b", "c"]
    assert rows(tables.describe_table(spark, "changing")) == [("b", "bigint"), ("c", "string")]
    assert values(tables.list_tables(spark, ["changing", "absent"]), "table_name") == ["changing"]
    assert rows(tables.row_counts({"changing": tables.read_table(spark, "changing")})) == [("changing", 2)]
    spark.sql("DROP TABLE changing")


def test_sql_text_and_its_errors(spark):
    spark.range(4).createOrReplaceTempView("four")
    assert rows(tables.run_query(spark, "SELECT max(id) AS top FROM four")) == [(3,)]
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        tables.run_query(spark, "SELECT * FROM absent_table")


def test_preview_is_ordered(spark):
    text = plan(audit.preview(spark.range(100), ["id"], 5))
    assert "TakeOrderedAndProject" in text


class Session:
    """A session with nothing but the settings that matter here."""

    def __init__(self, setting=None, master="local[2]"):
        self.conf = {storage.CHECKPOINT_SETTING: setting}
        self.sparkContext = self
        self.master, self.folder, self.applicationId = master, None, "app-1"

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_scratch_goes_to_the_named_folder():
    assert storage.new_location(Session("hdfs://x/y/"), "name").startswith("hdfs://x/y/curbsight/app-1/name-")
    assert storage.new_location(Session("s"), "n") != storage.new_location(Session("s"), "n")


def test_scratch_without_a_setting():
    local = Session()
    assert storage.shared_folder(local) == storage.shared_folder(local) == local.folder
    with pytest.raises(ValueError, match="executors share"):
        storage.shared_folder(Session(master="yarn"))


def test_clear_removes_only_what_this_application_wrote(spark, folder):
    class Own(Session):
        def __init__(self, name):
            super().__init__(folder)
            self.applicationId = name
            self._jvm, self._jsc = spark.sparkContext._jvm, spark.sparkContext._jsc

    ours, theirs = storage.new_location(Own("ours"), "t"), storage.new_location(Own("theirs"), "t")
    for path in (ours, theirs):
        spark.range(2).write.parquet(path)
    storage.clear(Own("ours"))
    assert not os.path.exists(ours) and os.path.exists(theirs)


def test_written_step_is_read_back(spark):
    df = storage.materialize(spark.range(3), "step")
    assert sorted(values(df, "id")) == [0, 1, 2]
    assert "ExistingRDD" not in plan(df) and "FileScan parquet" in plan(df)


def test_vectors_roundtrip(spark, folder):
    df = spark.createDataFrame([(1, [0.5, 0.25])], "vec_id bigint, embedding array<float>")
    vectors.write_vectors(df, folder)
    assert rows(vectors.read_vectors(spark, folder)) == rows(df)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        vectors.read_vectors(spark, folder + "/nowhere")


# --- JDBC: settings only, no database is started ---


def test_jdbc_target_from_environment():
    env = {"CURBSIGHT_JDBC_URL": "jdbc:x:y", "CURBSIGHT_JDBC_USER": "u", "CURBSIGHT_JDBC_PASSWORD": "hidden"}
    target = jdbc.JdbcTarget.from_environment(env=env)
    assert target.options() == {"url": "jdbc:x:y", "user": "u", "password": "hidden", "loginTimeout": "30"}
    assert "hidden" not in repr(target)
    with pytest.raises(ValueError, match="CURBSIGHT_JDBC_URL"):
        jdbc.JdbcTarget.from_environment(env={})


class Recorder:
    """Stands in for a reader or writer and notes what it is told."""

    def __init__(self):
        self.told = {}

    def format(self, name):
        self.told["format"] = name
        return self

    def mode(self, name):
        self.told["mode"] = name
        return self

    def option(self, key, value):
        self.told[key] = value
        return self

    def options(self, **given):
        self.told.update(given)
        return self

    def save(self):
        self.told["saved"] = True

    def load(self):
        return self.told


class Holder:
    def __init__(self):
        self.read = self.write = Recorder()


def test_jdbc_read_and_write_settings():
    target = jdbc.JdbcTarget("jdbc:x:y")
    told = jdbc.read_query(Holder(), target, "SELECT 1 AS test")
    assert told["dbtable"] == "(SELECT 1 AS test) t" and told["format"] == "jdbc"
    told = jdbc.read_relation(Holder(), target, "t", "id", 0, 100, 4)
    assert (told["partitionColumn"], told["lowerBound"], told["upperBound"], told["numPartitions"]) == ("id", 0, 100, 4)
    assert jdbc.list_relations(Holder(), target)["dbtable"] == jdbc.TABLE_LIST

    first, second = Holder(), Holder()
    jdbc.publish({"a": first, "b": second}, target, connections=3, keep_definition=True)
    for holder, name in ((first, "a"), (second, "b")):
        told = holder.write.told
        assert (told["dbtable"], told["mode"], told["numPartitions"], told["truncate"], told["saved"]) == (
            name, "overwrite", 3, True, True,
        )


# --- test-data views ---


def test_every_turn_is_in_a_ticket(spark):
    turns = [
        (1, 0, "system", "s"), (1, 1, "user", "u1"), (1, 2, "assistant", "a1"), (1, 3, "user", "u2"),
        (1, 4, "assistant", "a2"), (2, 0, "user", "only"), (3, 0, "assistant", "a"),
    ]
    df = adapters.tickets_from_conversations(
        spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    )
    found = {r.ticket_id: (r.complaint_description, r.service_response, r.resolution_notes) for r in df.collect()}
    one = adapters.TURNS
    assert found == {
        one + 2: ("u1", "a1", None), one + 4: ("u2", "a2", None), 2 * one + 1: ("only", None, None), 3 * one: (None, "a", None),
    }


def test_documents_hold_all_characters_of_user_and_assistant_turns(spark, sf_dir):
    spoken = spark.read.parquet(f"{sf_dir}/conversations.parquet").where("role IN ('user', 'assistant')")
    found = adapters.conversation_tickets(spark, sf_dir)
    chars = found.agg(F.sum(F.coalesce(F.length("complaint_description"), F.lit(0)) + F.coalesce(F.length("service_response"), F.lit(0))))
    assert chars.first()[0] == spoken.agg(F.sum(F.length("text"))).first()[0]
    texts = documents.render(found.withColumn("churn_risk_label", F.lit("low"))).collect()
    assert all(t.strip() in r.page_content for r in texts for t in (r.complaint_description, r.service_response) if t)


# --- CSV by name ---


def written(folder, text, name="f.csv"):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as file:
        file.write(text)
    return folder


HEADER = "ticket_id,customer_id,customer_segment,sla_plan,initial_message,agent_first_reply,resolution_summary,customer_sentiment,issue_type,csat_score,resolution_time_hours"


def test_columns_are_found_by_name(spark, folder):
    written(folder, "csat_score,issue_type,city," + HEADER.removesuffix(",issue_type,csat_score,resolution_time_hours") + ",resolution_time_hours\n3,bug,Rome,7,CUST_00001,s,p,m,r,z,t,1.5\n")
    row = csv_files.read_tickets(spark, folder).first().asDict()
    assert (row["ticket_id"], row["customer_id"], row["issue_type"], row["csat_score"], row["city"]) == (7, "CUST_00001", "bug", 3, "Rome")
    assert list(row) == [*csv_files.TICKET_SCHEMA.names, "city"]


@pytest.mark.parametrize("multi_line", [True, False])
def test_bad_cells_fail_or_are_set_aside(spark, folder, multi_line):
    written(folder, f"{HEADER}\n1,a,b,c,d,e,f,g,h,2,1.5\n2,a,b,c,d,e,f,g,h,x2,1.5\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD|x2"):
        csv_files.read_tickets(spark, folder, multi_line=multi_line).collect()
    good, rejected = csv_files.split_rejects(csv_files.read_tickets(spark, folder, multi_line=multi_line, rejects=True))
    assert values(good, "ticket_id") == [1]
    assert "x2" in values(rejected, csv_files.REJECTED)[0]


@pytest.mark.parametrize("multi_line", [True, False])
@pytest.mark.parametrize("columns", [["ticket_id"], ["csat_score"], ["initial_message", "ticket_id"], ["resolution_time_hours"], None])
def test_rejects_are_the_same_for_each_projection(spark, folder, columns, multi_line):
    written(folder, f"{HEADER}\n1,a,b,c,d,e,f,g,h,2,1.5\n2,a,b,c,d,e,f,g,h,x2,1.5\n3,a,b,c,d,e,f,g,h,,oops\n,a,b,c,d,e,f,g,h,1,1\n")
    good, rejected = csv_files.split_rejects(csv_files.read_tickets(spark, folder, multi_line=multi_line, rejects=True))
    strict = csv_files.read_tickets(spark, folder, multi_line=multi_line)
    assert (good.count(), rejected.count()) == (2, 2)
    chosen = columns or good.columns
    assert (len(good.select(chosen).collect()), len(rejected.select(chosen).collect())) == (2, 2)
    assert good.agg(F.count("*"), F.max(chosen[0])).first()[0] == 2
    for use in (lambda df: df.count(), lambda df: df.select(chosen).collect(), lambda df: df.agg(F.max(chosen[0])).collect()):
        with pytest.raises(Exception, match="MALFORMED_RECORD|FAILFAST|oops|x2"):
            use(strict)


def test_missing_column_fails(spark, folder):
    written(folder, HEADER.replace(",issue_type", "") + "\n")
    with pytest.raises(ValueError, match="issue_type"):
        csv_files.read_tickets(spark, folder)


def test_files_of_another_layout_fail(spark, folder):
    written(folder, f"{HEADER}\n1,a,b,c,d,e,f,g,h,2,1.5\n", "a.csv")
    written(folder, ",".join(reversed(HEADER.split(","))) + "\n1.5,2,h,g,f,e,d,c,b,a,2\n", "b.csv")
    with pytest.raises(Exception, match="header|CSV"):
        csv_files.read_tickets(spark, folder).collect()


def test_export_is_read_by_name_and_split_if_asked(spark, folder):
    written(folder, "churn_risk_label,extra,property_id,complaint_description,service_response,resolution_notes,service_category\nhigh,x,p,c,s,r,k\n")
    for multi_line in (True, False):
        assert rows(csv_files.read_rag(spark, folder, ["property_id", "churn_risk_label"], multi_line=multi_line)) == [("p", "high")]


def test_files_sort_by_their_numbers(spark, folder):
    head = ",".join(csv_files.RAG_SCHEMA.names)
    for part, chunk in ((100000, 0), (99999, 1000), (99999, 999)):
        written(folder, f"{head}\n{part}-{chunk},c,s,r,k,l\n", f"part-{part:05}-ab12-c{chunk:03}.csv")
    back = csv_files.read_rag_in_order(spark, folder).orderBy("ingest_order")
    assert values(back, "property_id") == ["99999-999", "99999-1000", "100000-0"]


# --- scratch storage ---


def test_a_plans_scratch_goes_with_it(spark, tmp_path):
    outside = storage.new_location(spark, "stays")
    spark.range(1).write.parquet(outside)
    with storage.scratch(spark):
        inside = storage.new_location(spark, "goes")
        storage.materialize(spark.range(1), "goes too")
        spark.range(1).write.parquet(inside)
        assert os.path.exists(inside)
    assert not os.path.exists(os.path.dirname(inside)) and os.path.exists(outside)


@pytest.mark.parametrize("master", ["local-cluster[2,1,1024]", "spark://host:7077"])
def test_machine_folders_are_refused_on_a_cluster(spark, master):
    class Cluster(Session):
        def __init__(self, folder):
            super().__init__(folder)
            self.master = master
            self._jvm, self._jsc = spark.sparkContext._jvm, spark.sparkContext._jsc

    with pytest.raises(ValueError, match="folder of each machine"):
        storage.shared_folder(Cluster("/tmp/own"))
    with pytest.raises(ValueError, match="folder that all executors share"):
        storage.shared_folder(Cluster(None))
    assert storage.shared_folder(Cluster("file:///mounted")) == "file:///mounted"


def test_a_plain_path_that_executors_find_is_taken_on_a_cluster(spark, tmp_path):
    """As a cluster has it that names the mount of all machines without a scheme."""
    real = spark.sparkContext

    class Cluster(Session):
        def __init__(self, setting, made, name):
            super().__init__(str(setting), "local-cluster[2,1,1024]")
            self.folder, self.applicationId = f"file:{made}", name
            self._jvm, self._jsc, self.defaultParallelism, self.parallelize = real._jvm, real._jsc, 2, real.parallelize

    (tmp_path / "made").mkdir()
    assert storage.shared_folder(Cluster(tmp_path, tmp_path / "made", "one")) == str(tmp_path)
    assert storage.new_location(Cluster(f"{tmp_path}/", tmp_path / "made", "two"), "n").startswith(f"{tmp_path}/curbsight/two/n-")
    for setting, made in ((tmp_path, tmp_path / "unseen"), (tmp_path / "other", tmp_path / "made")):
        with pytest.raises(ValueError, match="folder of each machine"):
            storage.shared_folder(Cluster(setting, made, "three"))


def test_queries_that_write_run_with_a_plain_path_on_a_cluster(spark, sf_dir, tmp_path, monkeypatch):
    real, made = spark.sparkContext, tmp_path / "made"
    made.mkdir()
    monkeypatch.setattr(real, "master", "local-cluster[2,1,1024]")
    monkeypatch.setattr(real, "getCheckpointDir", lambda: f"file:{made}")
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, *a, f=type(spark.conf).get: str(tmp_path) if key == storage.CHECKPOINT_SETTING else f(self, key, *a))
    assert QUERIES["answer_lines"](spark, sf_dir).count() > 0
    assert os.listdir(tmp_path / "curbsight")


def test_tables_with_files_here_are_dropped(spark, folder):
    tables.write_table(spark.range(1), "kept_elsewhere", folder + "/kept")
    tables.write_table(spark.range(1), "passing_table", storage.new_location(spark, "passing"))
    storage.drop_tables(spark)
    assert spark.catalog.tableExists("kept_elsewhere") and not spark.catalog.tableExists("passing_table")


def test_ids_beyond_five_digits_keep_all_digits(spark):
    ids = spark.createDataFrame([(7,), (1234567,)], "n bigint").select(adapters._property_id(F.col("n")).alias("p"))
    assert values(ids, "p") == ["CUST_00007", "CUST_1234567"]


def test_document_text(spark):
    df = spark.createDataFrame(
        [("P", "c\n", None, "  done \n\u00a0\u2003", None, "high")],
        """property_id string, complaint_description string, service_response string, resolution_notes string,
           service_category string, churn_risk_label string""",
    )
    row = documents.render(df).first()
    assert row.page_content == (
        "Service Category: General\nChurn Risk: high\n\nCustomer Complaint:\nc\n\n\n"
        "Agent Response:\nNo response recorded\n\nResolution:\n  done"
    )
    assert row.metadata == {"property_id": "P", "service_category": "General", "churn_risk": "high"}


def test_stream_picks_up_only_new_files(spark, sf_dir, folder):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    arriving, out, progress = folder + "/in", folder + "/out", folder + "/progress"
    counts = []
    for part in ("event_id < 400", "event_id >= 400"):
        events.where(part).write.mode("append").parquet(arriving)
        stream = silver_stream.read_ticket_stream(spark, arriving, events.schema, adapters.tickets_from_events)
        silver_stream.append_silver(stream, adapters.AS_OF, out, progress)
        counts.append(spark.read.parquet(out).count())
    assert counts == [400, events.count()]
