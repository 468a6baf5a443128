"""Registered queries of files to choose from, names and roles, exports, refused loads and release pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as X
from tidemark.operators import filters, runs, shape
from tidemark.plans import loaders, marts
from tidemark.plans.landed import land_lines
from tidemark.plans.registry import published_root, query
from tidemark.schema import insert_ignore, state_seed_frame
from tidemark.sources import readers, sinks
from tidemark.sources.tables import Tables


def _counts(t: Tables) -> DataFrame:
    """Orders by year and priority."""
    o = t.read("orders", "o_orderdate", "o_orderpriority")
    return o.groupBy(F.year("o_orderdate").alias("y"), F.col("o_orderpriority").alias("priority")).agg(F.count(F.lit(1)).alias("n"))


@query("s12_message_log_files")
def q_s12(t: Tables) -> DataFrame:
    """Messages of fifty conversations a file, as a list in even files and as requests and responses in odd ones, read back."""
    m = marts.m_messages(t).withColumn("id", F.get_json_object("json", "$.data.id").cast("long"))
    # a file holds at most 100 turns of 50 conversations
    file = F.concat(F.floor(F.col("id") / 50_000).cast("string"), F.lit("_"), F.floor(F.pmod("id", F.lit(1000)) / 100).cast("string"))
    odd = F.floor(F.col("id") / 50_000) % 2 == 1
    sent = F.get_json_object("json", "$.dir") == "sent"
    boxed = F.to_json(F.struct(F.col("json").alias("j")))
    quoted = F.substring(boxed, F.lit(6), F.length(boxed) - 6)  # the message as a JSON text: of {"j":"..."} what is quoted
    logs = m.groupBy(file.alias("file"), odd.alias("odd")).agg(
        F.concat_ws(",", F.collect_list("json")).alias("every"), F.concat_ws(",", F.collect_list(F.when(sent, F.col("json")))).alias("sent"),
        F.concat_ws(",", F.collect_list(F.when(~sent, quoted))).alias("received"))
    objects = F.concat(F.lit('{"requests":['), "sent", F.lit('],"responses":['), "received", F.lit("]}"))
    lines = logs.select("file", F.lit(0).alias("seq"), F.when(F.col("odd"), objects).otherwise(F.concat(F.lit("["), "every", F.lit("]"))).alias("line"))
    messages = readers.read_messages(t.spark, land_lines(lines, f"{published_root(t)}/logs"))
    return messages.groupBy("dir").agg(F.count(F.lit(1)).alias("messages"), F.count("id").alias("with_id"), F.sum(F.get_json_object("json", "$.ts").cast("long")).alias("ts_sum"))


@query("s13_s14_newest_of_the_first_source")
def q_s13(t: Tables) -> DataFrame:
    """Of three places the first that holds a release, and its newest file by name, read and counted."""
    root = published_root(t)
    _counts(t).write.partitionBy("y").parquet(f"{root}/local")
    _counts(t).limit(0).write.json(f"{root}/empty")
    folder, glob = readers.first_available(t.spark, [(f"{root}/absent", "*.parquet"), (f"{root}/empty", "*.parquet"), (f"{root}/local", "*.parquet")])
    newest = readers.newest_file(t.spark, folder, glob).rsplit("/", 1)[0]
    return t.spark.read.option("basePath", folder).parquet(newest).select(F.col("y").cast("int").alias("y"), "priority", "n")


@query("s15_s16_reference_file_and_seeds")
def q_s15(t: Tables) -> DataFrame:
    """Regions as a reference CSV loaded twice as the dimension of states; seeds fill in what it lacks."""
    root = published_root(t)
    n = t.read("nation", "n_nationkey", "n_name")
    code = F.when(F.col("n_nationkey") == 0, "NSW").otherwise(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")))
    n.select(code.alias("state_code"), F.concat("n_name", F.lit(", the")).alias("state_name"), F.lit(0).alias("is_territory")).write.option("header", True).csv(f"{root}/reference")
    for _ in range(2):
        known = readers.read_csv(t.spark, f"{root}/reference", "state_code STRING, state_name STRING, is_territory INT")
        sinks.upsert(t.spark, insert_ignore(known, state_seed_frame(t.spark), ["state_code"]), root, "dim_state", ["state_code"])
    return sinks.read_table(t.spark, root, "dim_state")


@query("k05_k07_k08_exports")
def q_k07(t: Tables) -> DataFrame:
    """Line item counts exported as CSV, at most 100 rows a file, NULL as a mark; read back with the rows of the fullest file."""
    li = t.read("lineitem", "l_shipdate", "l_returnflag", "l_linestatus")
    flag = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    rows = li.groupBy(F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"), flag.alias("flag")).agg(F.count(F.lit(1)).alias("n"))
    root = published_root(t)
    for part in (rows.limit(1), rows):
        counted = sinks.overwrite_and_count(t.spark, part, f"{root}/plain")
    sinks.export_csv(t.spark.read.parquet(f"{root}/plain"), f"{root}/csv", null_value="\\N", max_records=100)
    marked = t.spark.read.option("header", True).csv(f"{root}/csv").select("*", F.col("_metadata.file_path").alias("file"))
    fullest = marked.groupBy("file").agg(F.count(F.lit(1)).alias("rows")).agg(F.max("rows") <= 100).scalar()
    back = t.spark.read.option("header", True).option("nullValue", "\\N").schema("day STRING, flag STRING, n BIGINT").csv(f"{root}/csv")
    return back.select("*", fullest.alias("within_cap"), F.lit(counted).cast("long").alias("overwritten_rows"))


@query("k06_k09_g12_loads_that_change_nothing")
def q_k09(t: Tables) -> DataFrame:
    """A published release, then a dry run, a short load, a load of repeated keys and a release of which one table is bad: what each
    says, and the rows that readers still see."""
    root, rows = published_root(t), _counts(t)
    keys = {"by_priority": ["y", "priority"], "nations": ["n_nationkey"]}
    nations = t.read("nation", "n_nationkey", "n_name")
    sinks.publish_release(t.spark, root, {"by_priority": rows, "nations": nations}, keys)
    more = rows.unionByName(rows.withColumn("y", F.col("y") + 100))
    tries = {
        "dry run": lambda: sinks.replace_table(t.spark, more, root, "by_priority", keys["by_priority"], dry_run=True).rows_written,
        "short load": lambda: sinks.replace_table(t.spark, more, root, "by_priority", keys["by_priority"], expected_rows=1).rows_written,
        "repeated keys": lambda: sinks.replace_table(t.spark, rows.unionByName(rows), root, "by_priority", keys["by_priority"]).rows_written,
        "half a release": lambda: len(sinks.publish_release(t.spark, root, {"by_priority": more, "nations": nations.unionByName(nations)}, keys)),
    }
    said = []
    for name, run in tries.items():
        try:
            said.append((name, True, run()))
        except sinks.LoadError:
            said.append((name, False, None))
    told = t.spark.createDataFrame(said, "attempt STRING, accepted BOOLEAN, rows BIGINT")
    live = loaders.table_counts(t.spark, root, list(keys)).agg(F.sum("rows")).scalar()
    return told.select("*", live.alias("rows_live"))


@query("u04_missing_tables_and_columns")
def q_u04(t: Tables) -> DataFrame:
    root, rows = published_root(t), _counts(t)
    sinks.append_rows(t.spark, rows, root, "by_priority")
    lacking = [("table", n) for n in loaders.missing_tables(t.spark, root, ["by_priority", "by_segment"])]
    lacking += [("column", n) for n in loaders.missing_columns(sinks.read_table(t.spark, root, "by_priority"), ["y", "priority", "state_code"])]
    held = sinks.read_table(t.spark, root, "by_priority").agg(F.sum("n")).scalar()
    return t.spark.createDataFrame(lacking, "kind STRING, name STRING").select("*", held.alias("orders_loaded"))


@query("r16_two_grains_apart")
def q_r16(t: Tables) -> DataFrame:
    """The basic and the detailed fact of one population, each checked on its own key and published on its own."""
    root = published_root(t)
    basic, detailed = marts.m_enrol(t), marts.m_enrol_detailed(t)
    key = ["enrol_year", "enrol_month", "nationality", "sector", "state_code"]
    loaders.load_enrolment_grains(t.spark, basic, detailed, root, key, [*key, "field_of_education", "level_of_study"])
    tables = ["fact_student_enrolment", "fact_student_enrolment_detailed"]
    parts = [sinks.read_table(t.spark, root, n).select(F.lit(n).alias("table_name"), "ytd_enrolments") for n in tables]
    return parts[0].unionByName(parts[1]).groupBy("table_name").agg(F.count(F.lit(1)).alias("rows"), F.sum("ytd_enrolments").alias("ytd"))


@query("g17_load_gate_of_a_dry_run")
def q_g17(t: Tables) -> DataFrame:
    """Each event type's rows as a dry run would report them; types of fewer than a fifth of the events count as empty."""
    e = t.read("events", "event_type")
    share = F.lit(5) * F.count(F.lit(1)) >= e.agg(F.count(F.lit(1))).scalar()
    summary = e.groupBy(F.col("event_type").alias("source")).agg(F.when(share, F.count(F.lit(1))).otherwise(0).alias("rows")) \
        .select("source", F.when(F.col("rows") > 0, "ok").otherwise("empty").alias("status"), "rows")
    return runs.load_gate(summary).select("passed", F.array_join("blocking_sources", ",").alias("blocking"))


@query("p06_where_data_begins")
def q_p06(t: Tables) -> DataFrame:
    """A sheet a year with as many rows above its data as the year's last digit says; the first of them is blank."""
    o = t.read("orders", "o_orderdate")
    monthly = o.groupBy(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")).agg(F.count(F.lit(1)).alias("n"))
    above = F.col("y") % 10
    data = monthly.select(F.lit("series.xlsx").alias("path"), F.col("y").cast("string").alias("sheet"), (above + F.col("m") - 1).alias("row_idx"),
                          F.array(F.date_format(F.make_date("y", "m", F.lit(1)), "dd-MMM-yyyy"), F.col("n").cast("string")).alias("cells"))
    head = monthly.select("y").distinct().where(above > 0).select(F.lit("series.xlsx").alias("path"), F.col("y").cast("string").alias("sheet"),
                                                                  F.explode(F.sequence(F.lit(0), above - 1)).alias("row_idx")) \
        .select("*", F.array(F.when(F.col("row_idx") > 0, F.lit("Month")), F.lit("Orders")).alias("cells"))
    return shape.data_start_rows(data.unionByName(head)).select("sheet", "data_start")


@query("p08_p09_p14_p15_columns_of_a_frame")
def q_p08(t: Tables) -> DataFrame:
    """Columns renamed by synonym, kept where present, completed by defaults and required, and summed."""
    li = t.read("lineitem", "l_returnflag", "l_linestatus", "l_quantity", "l_tax")
    named = shape.rename_with_fallback(li, {"flag": ["flag", "l_flag", "l_returnflag", "l_linestatus"], "quantity": ["qty", "l_quantity"]})
    kept, _ = shape.keep_present(named, ["flag", "quantity", "l_linestatus", "price"])
    full = shape.add_defaults(kept, {"price": 2.5, "flag": "none"})
    shape.require_columns(full, ["flag", "quantity", "price"])
    return full.groupBy("flag", "l_linestatus").agg(F.sum("quantity").alias("quantity"), F.max("price").alias("price"))


@query("p10_p11_p19_roles_of_columns")
def q_p10(t: Tables) -> DataFrame:
    """The roles that keywords give the columns of three tables, which column holds the measure, and whether the layout is long."""
    rules = [("date", ["date"]), ("price", ["price", "acctbal"]), ("flag", ["flag", "status"]), ("key", [("key",)])]
    rows = []
    for table in ("lineitem", "orders", "customer"):
        df = t.read(table)
        measure, is_long = shape.detect_value_column(df.select(*df.columns)), shape.is_long_layout(df.columns)
        for column, role in shape.assign_roles(df.columns, rules, repeatable=("key",)).items():
            rows.append((table, column, role, column == measure, is_long))
    sizes = None
    for table in ("lineitem", "orders", "customer"):
        part = t.read(table).agg(F.count(F.lit(1)).alias("n")).select(F.lit(table).alias("table_name"), "n")
        sizes = part if sizes is None else sizes.unionByName(part)
    return t.spark.createDataFrame(rows, "table_name STRING, column_name STRING, role STRING, is_measure BOOLEAN, is_long BOOLEAN").join(sizes, "table_name")


@query("p17_p18_context_of_file_names")
def q_p17(t: Tables) -> DataFrame:
    """Export names of four shapes made from each order's month and priority, read back as context and dimensions."""
    o = t.read("orders", "o_orderkey", "o_orderdate", "o_orderpriority")
    m, y = F.month("o_orderdate").cast("string"), F.year("o_orderdate").cast("string")
    digit = F.substring("o_orderpriority", 1, 1)
    name = F.when(digit == "1", F.concat(m, F.lit("-"), y, F.lit("-190_Invited_English_State_Groups.csv"))) \
        .when(digit == "2", F.concat(F.lpad(m, 2, "0"), F.lit("_"), y, F.lit("_491_Submitted.csv"))) \
        .when(digit == "3", F.concat(F.lit("export_"), y, F.lit("_All_Lodged_ProfYear.csv"))) \
        .when(digit == "4", F.concat(F.lit("Occupations_"), y, F.lit(".v2.csv"))).otherwise(F.concat(y, F.lit("_189.csv")))
    names = o.select(name.alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    context = names.select("file", "n", *[c.alias(k) for k, c in shape.filename_context(F.col("file")).items()])
    return context.select("*", *[c.alias(k) for k, c in shape.view_dimensions(F.col("source_view")).items()])


@query("x24_b11_newest_complete_release")
def q_b11(t: Tables) -> DataFrame:
    """A page a year with a heading and a link for each month's two files; the second is missing where a month has fewer orders than
    its page's average.  The newest month with both, of each page."""
    o = t.read("orders", "o_orderdate")
    monthly = o.groupBy(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")).agg(F.count(F.lit(1)).alias("n"))
    yearly = monthly.groupBy("y").agg(F.avg("n").alias("mean"))

    def block(label: str, slug: str):
        head = F.concat(F.lit("<h3>"), X.month_label("y", "m"), F.lit(f" {label}</h3><p>text</p>"))
        return F.concat(head, F.lit('<a class="file type-xlsx" href="/download/'), F.col("m").cast("string"), F.lit(f'/{slug}/xlsx">x</a>'))

    html = F.concat(block("Latest data", "latest"), F.when(F.col("n") >= F.col("mean"), block("All data", "all")).otherwise("<h3>About</h3>"))
    pages = monthly.join(yearly, "y").withColumn("part", F.struct("m", html.alias("html"))).groupBy(F.col("y").alias("page_id")) \
        .agg(F.concat_ws("", F.transform(F.array_sort(F.collect_list("part")), lambda p: p["html"])).alias("html"))
    links = readers.release_links(pages, "https://releases.example.org")
    links = links.where(readers.allowed_url(F.col("url"), "releases.example.org"))
    complete = links.groupBy("page_id", "year", "month").agg(F.collect_set("kind").alias("kinds"), F.max(F.when(F.col("kind") == "all_data", F.col("url"))).alias("url")).where(F.size("kinds") == 2)
    newest = complete.groupBy("page_id").agg(F.max(F.struct("month", "url")).alias("x")).select("page_id", F.col("x.month").alias("month"), F.col("x.url").alias("url"))
    over_all = readers.newest_complete_release(links).select(F.col("year").cast("int").alias("page_id"), F.lit(True).alias("newest_of_all"))
    return newest.join(over_all, "page_id", "left").select("page_id", "month", "url", F.coalesce("newest_of_all", F.lit(False)).alias("newest_of_all"))


@query("s08_sheets_by_entity")
def q_s08(t: Tables) -> DataFrame:
    """Sheet names made of words of each part's name, routed to the entities of the provider register."""
    p = t.read("part", "p_partkey", "p_size")
    words = F.array(*[F.lit(w) for w in ("Institutions", "Course Locations", "Courses", "Locations", "Notes", "PROVIDER list", "course-location (2)")])
    sheet = F.element_at(words, F.col("p_size") % 7 + 1)
    return p.groupBy(sheet.alias("sheet"), filters.route_sheet(sheet, filters.PROVIDER_SHEET_ROUTES).alias("entity")).agg(F.count(F.lit(1)).alias("n"))


