"""Registered queries over the supplied tables, and their DuckDB oracles.

runs the library operator over the whole tables. Doubles are rounded to 6
decimals so Spark and DuckDB results can be hashed and compared.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from . import oracle
from .design import SurveyDesign
from .functions.columns import epoch_millis
from .operators.cleaning import (CHANGE_TYPES, FIXED_LISTS, choice_lists, choice_lists_wide,
                                 column_manifest, other_options, recode_others,
                                 validate_cleaning_log, variable_tracker)
from .functions.stats import normal_quantile
from .operators.duration import interview_duration
from .operators.estimates import Analysis, survey_results
from .operators.odds import odds_ratio_counts, odds_ratios
from .operators.sampling import (base_sample_size, sample_sizes, stratified_sample,
                                 weight_diagnostics)
from .operators.tables import label_results, numeric_value_columns, result_tiles, results_wide, review_labels
from .plans.analysis_list import SURVEY_METADATA, analysis_list
from .functions.joins import lookup_join
from .plans.cleaning_log import write_cleaning_log
from .plans.publish import read_published
from .plans.results import multi_results, write_results
from .session import scratch_path
from .sources.audit import audit_log, read_audit_csv
from .sources.multichoice import expand_select_multiple, members_long
from .sources.submissions import read_form_versions, read_submissions, split_repeats

DEC = oracle.R


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rounded(df: DataFrame, decimals: int = DEC) -> DataFrame:
    """Round every double column (for hash comparison with the oracle)."""
    return df.select(*[F.round(F.col(f"`{f.name}`"), decimals).alias(f.name)
                       if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def _overall_and(var, atype, groups, level=0.95):
    return [Analysis(var, atype, level, None)] + [Analysis(var, atype, level, g) for g in groups]


# --- W5 estimates -----------------------------------------------------------

def q_survey_prop_select_one(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    loa = _overall_and("l_linestatus", "prop_select_one", ["l_returnflag"])
    return rounded(survey_results(li, SurveyDesign("l_suppkey", "l_quantity"), loa))


def q_survey_prop_logit(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    loa = _overall_and("l_linestatus", "prop_select_one", ["l_returnflag"])
    return rounded(survey_results(li, SurveyDesign("l_suppkey", "l_quantity"), loa,
                                  ci_method="logit"))


def q_survey_mean(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    loa = (_overall_and("l_extendedprice", "mean", ["l_returnflag"])
           + _overall_and("l_discount", "mean", ["l_returnflag"]))
    return rounded(survey_results(li, SurveyDesign("l_suppkey", "l_quantity"), loa))


def q_survey_median(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    loa = (_overall_and("l_discount", "median", ["l_returnflag"])
           + _overall_and("l_extendedprice", "median", ["l_returnflag"]))
    return rounded(survey_results(li, SurveyDesign("l_suppkey", "l_quantity"), loa))


def q_survey_prop_select_multiple(spark, sf_dir):
    part = expand_select_multiple(table(spark, sf_dir, "part"), "p_name")
    loa = _overall_and("p_name", "prop_select_multiple", ["p_brand"])
    return rounded(survey_results(part, SurveyDesign(None, "p_size"), loa))


def q_survey_all_types(spark, sf_dir):
    """Every analysis type in one plan: multi-choice, single-choice, mean and
    median, overall and by brand."""
    part = expand_select_multiple(table(spark, sf_dir, "part"), "p_name")
    loa = (_overall_and("p_name", "prop_select_multiple", ["p_brand"])
           + _overall_and("p_type", "prop_select_one", ["p_brand"])
           + _overall_and("p_retailprice", "mean", ["p_brand"])
           + _overall_and("p_retailprice", "median", ["p_brand"]))
    return rounded(survey_results(part, SurveyDesign(None, "p_size"), loa))


def q_survey_prop_packed(spark, sf_dir):
    """Select-multiple proportions from the packed answers themselves: no
    member columns, choices found as data."""
    loa = _overall_and("p_name", "prop_select_multiple", ["p_brand"])
    return rounded(survey_results(table(spark, sf_dir, "part"), SurveyDesign(None, "p_size"), loa, choices="text"))


def q_expand_select_multiple(spark, sf_dir):
    part = expand_select_multiple(table(spark, sf_dir, "part"), "p_name")
    return members_long(part, "p_name", "p_partkey")


# --- W9-W11 sampling ----------------------------------------------------------

def q_sample_sizes(spark, sf_dir):
    return sample_sizes(table(spark, sf_dir, "orders"), "o_orderpriority", 0.95, 0.05)


def q_stratified_sample(spark, sf_dir):
    return rounded(stratified_sample(table(spark, sf_dir, "orders"), "o_orderpriority",
                                     "o_orderkey", 0.95, 0.05, seed=42))


def q_weight_diagnostics(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return rounded(weight_diagnostics(li, "l_quantity", by="l_returnflag", overall=True))


# --- W4, W6-W8 analysis list and tables --------------------------------------

PART_FORM = [("select_multiple name_list", "p_name"), ("select_one brand_list", "p_brand"),
             ("integer", "p_size"), ("decimal", "p_retailprice"), ("text", "p_type")]


def q_analysis_list(spark, sf_dir):
    part = expand_select_multiple(table(spark, sf_dir, "part"), "p_name")
    form = spark.createDataFrame(PART_FORM, "type string, name string")
    return analysis_list(spark, form=form, data=part, level=0.95,
                         group_vars=["p_brand", "p_type"])


def _lineitem_results(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    loa = (_overall_and("l_linestatus", "prop_select_one", ["l_returnflag"])
           + _overall_and("l_discount", "mean", ["l_returnflag"]))
    return survey_results(li, SurveyDesign("l_suppkey", "l_quantity"), loa)


def q_results_wide(spark, sf_dir):
    return rounded(results_wide(_lineitem_results(spark, sf_dir), "l_returnflag"))


def _customer_dictionary(spark, sf_dir):
    questions = spark.createDataFrame(
        [("select_one segment", "c_mktsegment", "Market segment"),
         ("select_one nation", "c_nationkey", "Nation")], "type string, name string, label string")
    nation = table(spark, sf_dir, "nation")
    segs = table(spark, sf_dir, "customer").select("c_mktsegment").distinct()
    choices = (nation.select(F.lit("nation").alias("list_name"),
                             F.col("n_nationkey").cast("string").alias("name"),
                             F.col("n_name").alias("label"))
               .unionByName(segs.select(F.lit("segment").alias("list_name"),
                                        F.col("c_mktsegment").alias("name"),
                                        F.lower("c_mktsegment").alias("label"))))
    return questions, choices


def q_label_results(spark, sf_dir):
    cust = table(spark, sf_dir, "customer")
    res = survey_results(cust, SurveyDesign(None, None),
                         _overall_and("c_mktsegment", "prop_select_one", ["c_nationkey"]))
    questions, choices = _customer_dictionary(spark, sf_dir)
    return rounded(label_results(res, questions, choices, "label"))


def q_review_labels(spark, sf_dir):
    questions, choices = _customer_dictionary(spark, sf_dir)
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    by_region = (nation.join(region, nation.n_regionkey == region.r_regionkey)
                       .select(F.lit("nation_region").alias("list_name"),
                               F.col("n_nationkey").cast("string").alias("name"),
                               F.col("r_name").alias("label")))
    return review_labels(questions, choices.unionByName(by_region), "label")


def q_run_summary(spark, sf_dir):
    import uuid
    li = table(spark, sf_dir, "lineitem")
    loa = (_overall_and("l_linestatus", "prop_select_one", ["l_returnflag"])
           + _overall_and("l_discount", "mean", ["l_returnflag", "l_linestatus"])
           + _overall_and("l_discount", "median", ["l_returnflag"])
           + [Analysis("no_such_column", "mean")])
    out = scratch_path(spark, f"results-{uuid.uuid4().hex[:12]}")
    return multi_results(li, SurveyDesign("l_suppkey", "l_quantity"), loa, out,
                         use_labels=False).summary.drop("path")


def q_results_rerun(spark, sf_dir):
    """Failed and repeated writes: a first run, one that may not overwrite,
    one whose wide tables fail, one that overwrites. Status rows of all runs,
    with the rows that the published table has after each."""
    out = scratch_path(spark, f"rerun-{uuid4().hex}")
    res = _lineitem_results(spark, sf_dir).checkpoint()
    runs = [(res, {}), (res, {"overwrite": False}), (res.drop("n"), {}), (res.where("analysis_type = 'mean'"), {})]
    statuses = []
    for number, (rows, options) in enumerate(runs, 1):
        summary, _ = write_results(rows, out, **options)
        left = read_published(spark, out, "Desc_Table__l_returnflag").count()
        error = F.when(F.col("error").contains("already exists"), "exists").when(F.col("error").contains("missing column"), "columns")
        statuses.append(summary.select(F.lit(number).alias("run"), "group", "safe_name", "success", "write_ok",
                                       error.alias("error"), F.lit(left).cast("long").alias("rows_left")))
    done = statuses[0]
    for more in statuses[1:]:
        done = done.unionByName(more)
    return done


def q_results_tiles(spark, sf_dir):
    """The variable x group table in tiles of eight group values."""
    res = survey_results(table(spark, sf_dir, "customer"), SurveyDesign(None, None),
                         _overall_and("c_mktsegment", "prop_select_one", ["c_nationkey"]))
    return rounded(result_tiles(res, "c_nationkey", ("stat", "n"), width=8).rows)


def q_results_csv(spark, sf_dir):
    """NULL text at the sink and numbers read back: the wide table written as
    CSV with ``NA`` for NULL, and its value columns coerced to numbers."""
    out = scratch_path(spark, f"csv-{uuid4().hex}")
    write_results(_lineitem_results(spark, sf_dir), out, fmt="csv", na_text="NA")
    back = spark.read.option("header", True).csv(f"{out}/Desc_Table__l_returnflag")
    return rounded(numeric_value_columns(back))


# --- W12 odds ratios ----------------------------------------------------------

ODDS_REFS = {"lang": "en", "source": "src0"}


def _labelled_documents(spark, sf_dir):
    labels, docs = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents")
    return labels.join(docs.select("doc_id", "lang", "source"), "doc_id")


def q_odds_ratio_counts(spark, sf_dir):
    return rounded(odds_ratio_counts(_labelled_documents(spark, sf_dir), "toxic", ODDS_REFS))


def q_odds_ratios(spark, sf_dir):
    return rounded(odds_ratios(_labelled_documents(spark, sf_dir), "toxic", ODDS_REFS))


# --- W1, W3 submissions and audit ---------------------------------------------

def events_as_audit(spark, sf_dir) -> DataFrame:
    """Events stand in for audit logs: uuid user_id, node event_type,
    start = event time in whole ms (truncated), end = start + value seconds."""
    ev = table(spark, sf_dir, "events")
    start = epoch_millis(ev, "ts")
    return ev.select(F.col("user_id").alias("uuid"), F.col("event_type").alias("node"),
                     start.alias("start"),
                     (start + F.round(F.col("value") * 1000).cast("long")).alias("end"))


#: Events that one attachment holds at most.
FILE_EVENTS = 20_000


def _audit_forms(rows: DataFrame):
    """(form, rows, columns) of two form versions: the first with hyphens in
    its header, the second with 40 columns more, in another order."""
    names = {"old-value": F.col("old"), "new-value": F.col("new"), "old_value": F.col("old"), "new_value": F.col("new"),
             **{f"x{i}": F.lit(None).cast("string") for i in range(40)}}
    first = ["event", "node", "start", "end", "old-value", "new-value"]
    second = [*(f"x{i}" for i in range(40)), "new_value", "old_value", "end", "start", "node"]
    form = F.pmod(F.coalesce(F.col("uuid").cast("string").try_cast("bigint"), F.length(F.col("uuid").cast("string"))), F.lit(2))
    return [("a", rows.withColumns(names).where(form == 0), first), ("b", rows.withColumns(names).where(form == 1), second)]


def _audit_rows(spark, sf_dir, interview: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    start = epoch_millis(ev, "ts")
    return ev.select(F.col(interview).alias("uuid"), F.xxhash64("event_id").alias("__salt"),
                     F.lit("question").alias("event"), F.col("event_type").alias("node"),
                     start.alias("start"), (start + F.round(F.col("value") * 1000).cast("long")).alias("end"),
                     F.concat(F.col("event_type"), F.lit(', "x"\nline '), F.col("event_id").cast("string")).alias("old"),
                     F.col("props").alias("new"))


def q_audit_log(spark, sf_dir):
    """The audit source on exports that hold many interviews: events are
    written as CSV files of two form versions, every record naming its user,
    and read back."""
    folder = scratch_path(spark, f"audit-{uuid4().hex}")
    for form, part, columns in _audit_forms(_audit_rows(spark, sf_dir, "user_id")):
        (part.select(F.col("uuid").alias("instance ID"), *[F.col(f"`{c}`") for c in columns])
             .write.option("header", True).option("escape", '"').csv(f"{folder}/form={form}"))
    return (read_audit_csv(spark, folder, instance=True).withColumn("uuid", F.col("instance").cast("long"))
            .select("uuid", "node", "start", "end", "old_value", "new_value"))


def q_audit_attachments(spark, sf_dir, interview: str = "event_type"):
    """The audit source on attachments: an interview's events are written as
    its own CSV files, of FILE_EVENTS events at most, and found through the
    attachments of the submissions. An interview with more events is dealt by
    event_id over several tasks."""
    rows = _audit_rows(spark, sf_dir, interview)
    files = F.ceil(F.count("*") / FILE_EVENTS).alias("__files")
    large = rows.groupBy(F.col("uuid").alias("__uuid")).agg(files).where("__files > 1").checkpoint()
    rows = lookup_join(rows, large, [("uuid", "__uuid")], "left").drop("__uuid").withColumn(
        "__part", F.pmod("__salt", F.coalesce("__files", F.lit(1))))
    folder = scratch_path(spark, f"audit-{uuid4().hex}")
    for form, part, columns in _audit_forms(rows):
        (part.repartition("uuid", "__part").select("uuid", *[F.col(f"`{c}`") for c in columns])
             .write.partitionBy("uuid").option("maxRecordsPerFile", FILE_EVENTS)
             .option("header", True).option("escape", '"').csv(f"{folder}/form={form}"))
    kind = rows.schema["uuid"].dataType
    listed = (spark.read.format("binaryFile").load(folder)
              .select(F.regexp_extract("path", "uuid=([^/]+)/", 1).cast(kind).alias("uuid"),
                      F.struct(F.lit("audit.csv").alias("media_file_basename"), F.col("path").alias("download_url")).alias("a")))
    subs = listed.groupBy("uuid").agg(F.collect_list("a").alias("_attachments"))  # the files of one interview
    return audit_log(subs, read_audit_csv(spark, folder)).drop("file")


def q_interview_duration(spark, sf_dir):
    subs = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "uuid")
    res = interview_duration(subs, events_as_audit(spark, sf_dir), remove_geo=True,
                             exclude_pattern="error")
    return rounded(res.df_and_duration)


LINE_FIELDS = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
               "l_returnflag"]


def q_split_repeats(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    nested = (li.groupBy("l_orderkey")
                .agg(F.array_sort(F.collect_list(F.struct(*LINE_FIELDS))).alias("lines")))
    orders = read_submissions(spark, f"{sf_dir.rstrip('/')}/orders.parquet", "parquet")
    subs = orders.join(nested, orders.o_orderkey == nested.l_orderkey, "left").drop("l_orderkey")
    return rounded(split_repeats(subs, key="o_orderkey", repeats=["lines"]).repeats["lines"])


def q_form_versions(spark, sf_dir):
    """JSON submissions of three form versions that share some questions, one
    of them with another type, read as VARIANT in one scan."""
    out = scratch_path(spark, f"forms-{uuid4().hex}")
    forms = [
        table(spark, sf_dir, "customer").select(
            F.concat(F.lit("c"), "c_custkey").alias("uuid"), F.lit("v1").alias("__version__"), F.col("c_nationkey").alias("area"),
            F.col("c_acctbal").alias("amount"), F.col("c_mktsegment").alias("grp/segment")),
        table(spark, sf_dir, "supplier").select(
            F.concat(F.lit("s"), "s_suppkey").alias("uuid"), F.lit("v2").alias("__version__"),
            F.concat(F.lit("area "), "s_nationkey").alias("area"), F.col("s_suppkey").alias("amount"), F.col("s_name").alias("name")),
        table(spark, sf_dir, "part").select(
            F.concat(F.lit("p"), "p_partkey").alias("uuid"), F.lit("v3").alias("__version__"), F.col("p_size").alias("size"),
            F.struct(F.col("p_retailprice").alias("price"), F.col("p_brand").alias("brand")).alias("item"),
            F.split("p_name", " ").alias("words"))]
    for k, form in enumerate(forms):
        form.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in form.columns])).alias("value")).write.text(f"{out}/form={k}")
    subs = read_form_versions(spark, out).submissions
    return rounded(subs.select(
        "uuid", F.col("__version__").alias("form_version"), "area", F.col("amount").cast("double").alias("amount"),
        F.col("`grp/segment`").alias("segment"), "name", F.col("size").cast("long").alias("size"),
        F.col("item.price").cast("double").alias("price"), F.col("item.brand").alias("brand"),
        F.get("words", F.lit(0)).alias("first_word"), F.when(F.col("words").isNotNull(), F.size("words")).alias("n_words")))


# --- W13-W17 cleaning log ------------------------------------------------------

CLEAN_FORM = [
    (1, "select_one segment_list", "c_mktsegment", None),
    (2, "text", "c_mktsegment_other", "${c_mktsegment} = 'other'"),
    (3, "select_multiple type_list", "p_type", None),
    (4, "text", "p_type_other", "selected(${p_type}, 'other')"),
    (5, "integer", "c_nationkey", None),
    (6, "begin_group", "grp", None),
    (7, "end group", "grp", None),
]
MISSING_SEGMENT = "HOUSEHOLD"  # left out of the segment list: its recodes are invalid
CHOICE_LIST_NAMES = ["change_type_validation", "binaries_sm_options_lgl", "binaries_sm_options_num",
                     "c_mktsegment", "p_type", "c_mktsegment_other", "p_type_other"]


def clean_form(spark):
    return spark.createDataFrame(CLEAN_FORM, "pos int, type string, name string, relevant string")


def clean_choices(spark, sf_dir):
    """Choice lists from the data: market segments (one left out) and part
    types, each followed by its 'other' answer; pos = sheet order."""
    cust, part = table(spark, sf_dir, "customer"), table(spark, sf_dir, "part")
    seg = (cust.where(F.col("c_mktsegment") != MISSING_SEGMENT)
               .select(F.lit("segment_list").alias("list_name"), F.col("c_mktsegment").alias("name"))
               .distinct())
    typ = part.select(F.lit("type_list").alias("list_name"), F.col("p_type").alias("name")).distinct()
    others = spark.createDataFrame([("segment_list", "other"), ("type_list", "Other")],
                                   "list_name string, name string")
    allc = seg.unionByName(typ).withColumn("is_other", F.lit(0)).unionByName(
        others.withColumn("is_other", F.lit(1)))
    w = Window.partitionBy("list_name").orderBy("is_other", "name")
    return allc.select("list_name", "name", F.row_number().over(w).alias("pos"))


def q_other_options(spark, sf_dir):
    return other_options(clean_form(spark), clean_choices(spark, sf_dir))


def q_choice_lists(spark, sf_dir):
    return choice_lists(clean_choices(spark, sf_dir), clean_form(spark), others=True)


def _validation_log(spark, sf_dir):
    cust, part = table(spark, sf_dir, "customer"), table(spark, sf_dir, "part")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    cols = ["uuid", "question", "change_type", "issue", "new_value"]
    a = cust.select(F.col("c_custkey").cast("string"), F.lit("c_mktsegment"),
                    F.when(F.col("c_acctbal") < 0, "blank_response").otherwise("change_response"),
                    F.lit("check"), F.col("c_mktsegment")).toDF(*cols)
    b = part.select(F.col("p_partkey").cast("string"), F.concat(F.lit("p_type/"), F.lower("p_type")),
                    F.lit("change_response"), F.lit("check"),
                    F.when(F.col("p_size") > 25, "1").otherwise("TRUE")).toDF(*cols)
    c = nation.select(F.lit("all"), F.lit("c_mktsegment"), F.lit("no_action"), F.lit("check"),
                      F.col("n_name")).toDF(*cols)
    d = region.select(F.col("r_regionkey").cast("string"), F.lit("c_nationkey"), F.lit("delete"),
                      F.lit("check"), F.col("r_name")).toDF(*cols)
    return a.unionByName(b).unionByName(c).unionByName(d)


def q_validate_cleaning_log(spark, sf_dir):
    return validate_cleaning_log(_validation_log(spark, sf_dir), clean_form(spark),
                                 clean_choices(spark, sf_dir))


def q_cleaning_log_tables(spark, sf_dir):
    """The cleaning-log writer: every table it wrote, read back, with its rows
    and the log's flags."""
    out = scratch_path(spark, f"log-{uuid4().hex}")
    cust = table(spark, sf_dir, "customer")
    paths = write_cleaning_log({"cleaning_log": _validation_log(spark, sf_dir), "clean_data": cust}, out, use_dropdown=True,
                               form=clean_form(spark), choices=clean_choices(spark, sf_dir))
    done = None
    for name, path in paths.items():
        back = spark.read.parquet(path)
        flagged = F.count(F.when(~F.col("new_value_ok"), 1)) if name == "cleaning_log" else F.lit(0)
        row = back.agg(F.count(F.lit(1)).alias("n_rows"), flagged.cast("long").alias("n_flagged")).select(
            F.lit(name).alias("name"), F.lit(len(back.columns)).alias("n_columns"), "n_rows", "n_flagged")
        done = row if done is None else done.unionByName(row)
    return done


def _recode_log(spark, sf_dir):
    cust, part = table(spark, sf_dir, "customer"), table(spark, sf_dir, "part")
    cols = ["uuid", "question", "change_type", "issue", "new_value"]
    a = cust.select(F.col("c_custkey").cast("string"), F.lit("c_mktsegment_other"),
                    F.lit("change_response"), F.lit("recode other"), F.col("c_mktsegment")).toDF(*cols)
    b = part.select(F.col("p_partkey").cast("string"), F.lit("p_type_other"),
                    F.lit("change_response"), F.lit("recode other"), F.col("p_type")).toDF(*cols)
    c = cust.select(F.col("c_custkey").cast("string"), F.lit("c_nationkey"),
                    F.lit("change_response"), F.lit("outlier"),
                    F.col("c_nationkey").cast("string")).toDF(*cols)
    d = part.select(F.col("p_partkey").cast("string"), F.lit("c_mktsegment"),
                    F.lit("change_response"), F.lit("typo"), F.col("p_name")).toDF(*cols)
    return a.unionByName(b).unionByName(c).unionByName(d)


def q_recode_others(spark, sf_dir):
    return recode_others(clean_form(spark), clean_choices(spark, sf_dir), _recode_log(spark, sf_dir))


def _clean_lineitem(li):
    return (li.drop("l_tax")
              .withColumn("l_net", F.col("l_extendedprice") * (1 - F.col("l_discount")))
              .withColumn("l_discount", F.when(F.col("l_returnflag") == "R", F.lit(None))
                          .otherwise(F.col("l_discount"))))


def q_choice_lists_wide(spark, sf_dir):
    long = choice_lists(clean_choices(spark, sf_dir), clean_form(spark), others=True)
    return choice_lists_wide(long, CHOICE_LIST_NAMES)


def q_recode_others_pair(spark, sf_dir):
    return recode_others(clean_form(spark), clean_choices(spark, sf_dir), _recode_log(spark, sf_dir),
                         match="pair")


def q_interview_audit(spark, sf_dir):
    subs = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "uuid")
    res = interview_duration(subs, events_as_audit(spark, sf_dir), remove_geo=True,
                             exclude_pattern="error")
    return rounded(res.audit)


def _clean_orders(orders):
    return orders.drop("o_orderstatus").withColumn("o_year", F.year("o_orderdate"))


def q_variable_tracker_schema(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return variable_tracker(column_manifest(orders, "o_orderpriority"),
                            column_manifest(_clean_orders(orders), "o_orderpriority"))


def q_variable_tracker(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    raw = column_manifest(li, "l_returnflag", present="values")
    clean = column_manifest(_clean_lineitem(li), "l_returnflag", present="values")
    return variable_tracker(raw, clean)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "survey_prop_select_one": q_survey_prop_select_one,
    "survey_prop_logit": q_survey_prop_logit,
    "survey_mean": q_survey_mean,
    "survey_median": q_survey_median,
    "survey_prop_select_multiple": q_survey_prop_select_multiple,
    "survey_all_types": q_survey_all_types,
    "survey_prop_packed": q_survey_prop_packed,
    "expand_select_multiple": q_expand_select_multiple,
    "sample_sizes": q_sample_sizes,
    "stratified_sample": q_stratified_sample,
    "weight_diagnostics": q_weight_diagnostics,
    "analysis_list": q_analysis_list,
    "results_wide": q_results_wide,
    "label_results": q_label_results,
    "review_labels": q_review_labels,
    "run_summary": q_run_summary,
    "results_rerun": q_results_rerun,
    "results_csv": q_results_csv,
    "results_tiles": q_results_tiles,
    "form_versions": q_form_versions,
    "cleaning_log_tables": q_cleaning_log_tables,
    "odds_ratio_counts": q_odds_ratio_counts,
    "odds_ratios": q_odds_ratios,
    "audit_log": q_audit_log,
    "audit_attachments": q_audit_attachments,
    "interview_duration": q_interview_duration,
    "split_repeats": q_split_repeats,
    "other_options": q_other_options,
    "choice_lists": q_choice_lists,
    "validate_cleaning_log": q_validate_cleaning_log,
    "recode_others": q_recode_others,
    "variable_tracker": q_variable_tracker,
    "choice_lists_wide": q_choice_lists_wide,
    "recode_others_pair": q_recode_others_pair,
    "interview_audit": q_interview_audit,
    "variable_tracker_schema": q_variable_tracker_schema,
}


def _union(*sqls: str) -> str:
    return "\nUNION ALL\n".join(f"SELECT * FROM ({s})" for s in sqls)


N0 = base_sample_size(0.95, 0.05)

ORACLE: dict[str, str] = {
    "survey_prop_select_one": oracle.survey_prop_sql(
        "lineitem", "l_suppkey", "l_quantity", "l_linestatus", ["l_returnflag"]),
    "survey_prop_logit": oracle.survey_prop_sql(
        "lineitem", "l_suppkey", "l_quantity", "l_linestatus", ["l_returnflag"],
        ci_method="logit"),
    "survey_mean": _union(
        oracle.survey_mean_sql("lineitem", "l_suppkey", "l_quantity", "l_extendedprice",
                               ["l_returnflag"]),
        oracle.survey_mean_sql("lineitem", "l_suppkey", "l_quantity", "l_discount",
                               ["l_returnflag"])),
    "survey_median": _union(
        oracle.survey_median_sql("lineitem", "l_suppkey", "l_quantity", "l_discount",
                                 ["l_returnflag"]),
        oracle.survey_median_sql("lineitem", "l_suppkey", "l_quantity", "l_extendedprice",
                                 ["l_returnflag"])),
    "survey_prop_select_multiple": oracle.survey_prop_sql(
        "part", None, "p_size", "p_name", ["p_brand"], multi=True),
    "expand_select_multiple": """
SELECT p.p_partkey, c.tok AS choice,
       CAST(list_contains(regexp_split_to_array(trim(p.p_name), '\\s+'), c.tok) AS INTEGER) AS selected
FROM part p,
     (SELECT DISTINCT unnest(regexp_split_to_array(trim(p_name), '\\s+')) AS tok FROM part) c
WHERE c.tok <> ''""",
    "sample_sizes": f"""
SELECT o_orderpriority, count(*) AS n,
       CAST(least(ceil({N0!r} / (1.0 + ({N0!r} - 1.0) / CAST(count(*) AS DOUBLE))), count(*)) AS BIGINT)
         AS sample
FROM orders GROUP BY o_orderpriority""",
    "stratified_sample": f"""
WITH s AS (
  SELECT o_orderpriority AS sp, count(*) AS n,
         CAST(least(ceil({N0!r} / (1.0 + ({N0!r} - 1.0) / CAST(count(*) AS DOUBLE))), count(*)) AS BIGINT)
           AS sample
  FROM orders GROUP BY o_orderpriority),
r AS (
  SELECT o.*, row_number() OVER (PARTITION BY o.o_orderpriority
                                 ORDER BY md5('42:' || CAST(o.o_orderkey AS VARCHAR)), o.o_orderkey) AS rk
  FROM orders o)
SELECT r.o_orderkey, r.o_custkey, r.o_orderstatus, round(r.o_totalprice, 6) AS o_totalprice,
       r.o_orderdate, r.o_orderpriority, s.n, s.sample, true AS incl
FROM r JOIN s ON r.o_orderpriority IS NOT DISTINCT FROM s.sp
WHERE r.rk <= s.sample""",
    "weight_diagnostics": """
WITH g AS (
  SELECT CAST(NULL AS VARCHAR) AS l_returnflag, CAST(NULL AS VARCHAR) AS grouped_by, count(*) AS n,
         CASE WHEN count(l_quantity) = count(*) THEN avg(l_quantity) END AS m,
         CASE WHEN count(l_quantity) = count(*) THEN stddev_samp(l_quantity) END AS sd
  FROM lineitem
  UNION ALL
  SELECT l_returnflag, 'l_returnflag', count(*),
         CASE WHEN count(l_quantity) = count(*) THEN avg(l_quantity) END,
         CASE WHEN count(l_quantity) = count(*) THEN stddev_samp(l_quantity) END
  FROM lineitem GROUP BY l_returnflag),
c AS (SELECT *, CASE WHEN m <> 0 THEN sd / m END AS cv FROM g),
e AS (SELECT *, n / (1.0 + cv * cv) AS neff FROM c)
SELECT l_returnflag, grouped_by, CAST(n AS BIGINT) AS n, round(m, 6) AS mean_weight, round(sd, 6) AS sd_weight,
       round(cv, 6) AS cv_weight, round(n / neff, 6) AS design_effect, round(neff, 6) AS effective_n,
       round(1.96 * sqrt(0.25 / neff) * 100.0, 6) AS margin_of_error_95
FROM e""",
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted stratified proportions and means, overall and by return
    flag, as a variable x group table."""
    return q_results_wide(spark, sf_dir)


def _loa_sql() -> str:
    form = ", ".join(f"('{t}', '{n}')" for t, n in PART_FORM)
    meta = ", ".join(f"'{m}'" for m in SURVEY_METADATA)
    return f"""
WITH form(type, name) AS (VALUES {form}),
cols AS (SELECT column_name AS name, data_type FROM information_schema.columns
         WHERE table_name = 'part'),
data_loa AS (
  SELECT name AS analysis_var,
         CASE WHEN data_type = 'VARCHAR' THEN 'prop_select_one'
              WHEN data_type IN ('BIGINT', 'INTEGER', 'SMALLINT', 'TINYINT', 'DOUBLE', 'FLOAT')
                   OR data_type LIKE 'DECIMAL%' THEN 'median:mean' END AS packed
  FROM cols
  WHERE name NOT IN ({meta}) AND name NOT LIKE '%/%' AND name NOT IN (SELECT name FROM form)),
form_loa AS (
  SELECT name AS analysis_var,
         CASE WHEN type IN ('integer', 'decimal') THEN 'mean:median'
              WHEN contains(type, 'select_one') THEN 'prop_select_one'
              WHEN contains(type, 'select_mult') THEN 'prop_select_multiple' END AS packed
  FROM form),
loa AS (SELECT analysis_var, unnest(string_split(packed, ':')) AS analysis_type
        FROM (SELECT * FROM data_loa UNION ALL SELECT * FROM form_loa) u WHERE packed IS NOT NULL),
g AS (SELECT unnest([NULL, 'p_brand', 'p_type']) AS group_var)
SELECT loa.analysis_var, loa.analysis_type, CAST(0.95 AS DOUBLE) AS level, g.group_var
FROM loa, g WHERE g.group_var IS NULL OR g.group_var <> loa.analysis_var"""


def _wide_sql() -> str:
    src = _union(
        oracle.survey_prop_sql("lineitem", "l_suppkey", "l_quantity", "l_linestatus",
                               ["l_returnflag"]),
        oracle.survey_mean_sql("lineitem", "l_suppkey", "l_quantity", "l_discount",
                               ["l_returnflag"]))
    cols = []
    for gv, cond in [("Overall", "group_var IS NULL")] + [
            (v, f"group_var = 'l_returnflag' AND group_var_value = '{v}'") for v in "ANR"]:
        for c in ("stat", "stat_upp", "stat_low", "n"):
            cols.append(f"max(CASE WHEN {cond} THEN {c} END) AS {gv}_{c}")
    return f"""
SELECT analysis_type, analysis_var, analysis_var_value, {', '.join(cols)}
FROM ({src}) r GROUP BY analysis_type, analysis_var, analysis_var_value"""


def _label_sql() -> str:
    res = oracle.survey_prop_sql("customer", None, None, "c_mktsegment", ["c_nationkey"])
    key = ("concat_ws(' @/@ ', r.analysis_type, concat_ws(' %/% ', {v}, coalesce({vv}, 'NA')), "
           "concat_ws(' %/% ', coalesce({g}, 'NA'), coalesce({gv}, 'NA')))")
    return f"""
WITH r AS ({res}),
qd(qn, ql, qlist) AS (VALUES ('c_mktsegment', 'Market segment', 'segment'),
                             ('c_nationkey', 'Nation', 'nation')),
cd AS (SELECT 'nation' AS cl, CAST(n_nationkey AS VARCHAR) AS cn, min(n_name) AS clab
       FROM nation GROUP BY 1, 2
       UNION ALL
       SELECT 'segment', c_mktsegment, min(lower(c_mktsegment)) FROM customer GROUP BY 1, 2),
l AS (
  SELECT r.*, coalesce(qv.ql, r.analysis_var) AS label_analysis_var,
         CASE WHEN r.analysis_var_value IS NOT NULL THEN coalesce(cv.clab, r.analysis_var_value) END
           AS label_analysis_var_value,
         CASE WHEN r.group_var IS NOT NULL THEN coalesce(qg.ql, r.group_var) END AS label_group_var,
         CASE WHEN r.group_var_value IS NOT NULL THEN coalesce(cg.clab, r.group_var_value) END
           AS label_group_var_value
  FROM r
  LEFT JOIN qd qv ON r.analysis_var = qv.qn
  LEFT JOIN cd cv ON qv.qlist = cv.cl AND r.analysis_var_value = cv.cn
  LEFT JOIN qd qg ON r.group_var = qg.qn
  LEFT JOIN cd cg ON qg.qlist = cg.cl AND r.group_var_value = cg.cn)
SELECT r.*, {key.format(v='r.label_analysis_var', vv='r.label_analysis_var_value',
                        g='r.label_group_var', gv='r.label_group_var_value')} AS label_analysis_key
FROM l r"""


def _review_sql() -> str:
    return """
WITH qs AS (SELECT * FROM (VALUES ('survey', CAST(NULL AS VARCHAR), 'c_mktsegment', 'Market segment'),
                                  ('survey', CAST(NULL AS VARCHAR), 'c_nationkey', 'Nation'))
            t(sheet, list_name, name, label)),
cs AS (SELECT 'choices' AS sheet, 'nation' AS list_name, CAST(n_nationkey AS VARCHAR) AS name,
              n_name AS label FROM nation
       UNION ALL
       SELECT DISTINCT 'choices', 'segment', c_mktsegment, lower(c_mktsegment) FROM customer
       UNION ALL
       SELECT 'choices', 'nation_region', CAST(n.n_nationkey AS VARCHAR), r.r_name
       FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
b AS (SELECT * FROM qs UNION ALL SELECT * FROM cs),
d AS (SELECT sheet, list_name, label FROM b WHERE label IS NOT NULL AND trim(label) <> ''
      GROUP BY sheet, list_name, label HAVING count(DISTINCT name) > 1)
SELECT sheet, list_name, name, label, 'missing label' AS issue FROM b
WHERE label IS NULL OR trim(label) = ''
UNION ALL
SELECT b.sheet, b.list_name, b.name, b.label, 'duplicated label'
FROM b JOIN d ON b.sheet = d.sheet AND b.list_name IS NOT DISTINCT FROM d.list_name AND b.label = d.label"""


ORACLE.update({
    "analysis_list": _loa_sql(),
    "results_wide": _wide_sql(),
    "label_results": _label_sql(),
    "review_labels": _review_sql(),
})


def _odds_sql() -> str:
    refs = ", ".join(f"('{g}', '{r}')" for g, r in ODDS_REFS.items())
    longs = " UNION ALL ".join(
        f"SELECT '{g}' AS group_var, CAST({g} AS VARCHAR) AS level, y FROM d "
        f"WHERE y IS NOT NULL AND {g} IS NOT NULL" for g in ODDS_REFS)
    return f"""
WITH d AS (SELECT CAST(l.toxic AS DOUBLE) AS y, x.lang, x.source
           FROM labels l JOIN documents x ON l.doc_id = x.doc_id),
lg AS ({longs}),
c AS (SELECT group_var, level, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS k1,
             sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS k0,
             sum(CASE WHEN y NOT IN (0, 1) THEN 1 ELSE 0 END) AS other
      FROM lg GROUP BY group_var, level),
v AS (SELECT group_var FROM c GROUP BY group_var
      HAVING count(*) >= 2 AND sum(other) = 0 AND sum(k1) > 0 AND sum(k0) > 0),
refs(group_var, ref_group) AS (VALUES {refs}),
a AS (SELECT c.group_var, r.ref_group, c.k1 AS a1, c.k0 AS a0
      FROM c JOIN refs r ON c.group_var = r.group_var AND c.level = r.ref_group),
t AS (SELECT c.group_var, a.ref_group, c.level, CAST(a.a1 AS DOUBLE) AS a1, CAST(a.a0 AS DOUBLE) AS a0,
             CAST(c.k1 AS DOUBLE) AS k1, CAST(c.k0 AS DOUBLE) AS k0
      FROM c JOIN v ON c.group_var = v.group_var JOIN a ON c.group_var = a.group_var
      WHERE c.level <> a.ref_group),
s AS (SELECT *, (a1 = 0 OR a0 = 0 OR k1 = 0 OR k0 = 0) AS separated FROM t)
SELECT 'toxic' AS question, group_var, ref_group, group_var || level AS term,
       CAST(a1 AS BIGINT) AS a1, CAST(a0 AS BIGINT) AS a0, CAST(k1 AS BIGINT) AS k1,
       CAST(k0 AS BIGINT) AS k0,
       round(CASE WHEN k0 * a1 <> 0 THEN k1 * a0 / (k0 * a1) END, 6) AS estimate,
       round(CASE WHEN NOT separated THEN sqrt(1 / a1 + 1 / a0 + 1 / k1 + 1 / k0) END, 6) AS se,
       round(CASE WHEN NOT separated THEN ln(k1 * a0 / (k0 * a1)) / sqrt(1 / a1 + 1 / a0 + 1 / k1 + 1 / k0)
             END, 6) AS z,
       separated
FROM s"""


ORACLE["odds_ratio_counts"] = _odds_sql()


def _odds_limits_sql(level: float = 0.95) -> str:
    """Profile limits by 80 bisections in a recursive query (the intercept at a
    fixed log odds ratio is the positive root of a quadratic), and the normal
    tail by the error function's power series."""
    crit = repr(normal_quantile((1 + level) / 2) ** 2)
    best = "a1 * ln(a1 / (a1 + a0)) + a0 * ln(a0 / (a1 + a0)) + k1 * ln(k1 / (k1 + k0)) + k0 * ln(k0 / (k1 + k0))"
    return f"""
WITH RECURSIVE o AS ({_odds_sql()}),
c AS (SELECT term, CAST(a1 AS DOUBLE) AS a1, CAST(a0 AS DOUBLE) AS a0, CAST(k1 AS DOUBLE) AS k1,
             CAST(k0 AS DOUBLE) AS k0 FROM o WHERE NOT separated),
e AS (SELECT *, ln(k1 * a0 / (k0 * a1)) AS beta, sqrt(1 / a1 + 1 / a0 + 1 / k1 + 1 / k0) AS se FROM c),
step AS (
  SELECT term, a1, a0, k1, k0, side, beta AS lo, beta + side * ({crit} * se + {crit} + 20) AS hi, 0 AS i
  FROM e, (VALUES (-1), (1)) AS sides(side)
  UNION ALL
  SELECT term, a1, a0, k1, k0, side, CASE WHEN d < {crit} THEN mid ELSE lo END,
         CASE WHEN d < {crit} THEN hi ELSE mid END, i + 1
  FROM (SELECT *, 2 * ({best} + a1 * ln(1 + 1 / u) + a0 * ln(1 + u) + k1 * ln(1 + 1 / (r * u)) + k0 * ln(1 + r * u)) AS d
        FROM (SELECT *, CASE WHEN b > 0 THEN 2 * (a1 + k1) / (b + q) ELSE (q - b) / (2 * r * (a0 + k0)) END AS u
              FROM (SELECT *, sqrt(b * b + 4 * r * (a0 + k0) * (a1 + k1)) AS q
                    FROM (SELECT *, a1 + a0 + (k1 + k0) * r - (a1 + k1) * (1 + r) AS b
                          FROM (SELECT *, (lo + hi) / 2 AS mid, exp((lo + hi) / 2) AS r FROM step WHERE i < 80)))))),
lim AS (SELECT term, max(CASE WHEN side = -1 THEN exp((lo + hi) / 2) END) AS conf_low,
               max(CASE WHEN side = 1 THEN exp((lo + hi) / 2) END) AS conf_high
        FROM step WHERE i = 80 GROUP BY term),
p AS (SELECT term, CASE WHEN x = 0 THEN 1.0 ELSE 1 - 2 / sqrt(pi()) * exp(-x * x) * list_sum(list_transform(range(0, 400),
               lambda n: exp(n * ln(2 * x * x) + ln(x) - ((n + 1) * ln(2) + lgamma(n + 1.5) - 0.5 * ln(pi()))))) END AS p_value
      FROM (SELECT term, abs(beta / se) / sqrt(2) AS x FROM e))
SELECT o.question, o.group_var, o.ref_group, o.term, o.estimate, round(lim.conf_low, 6) AS conf_low,
       round(lim.conf_high, 6) AS conf_high, round(p.p_value, 6) AS p_value, o.separated
FROM o LEFT JOIN lim ON lim.term = o.term LEFT JOIN p ON p.term = o.term"""


ORACLE["odds_ratios"] = _odds_limits_sql()

ORACLE["audit_log"] = """
SELECT user_id AS uuid, event_type AS node, epoch_us(ts) // 1000 AS start,
       epoch_us(ts) // 1000 + CAST(round(value * 1000) AS BIGINT) AS "end",
       event_type || ', "x"' || chr(10) || 'line ' || event_id AS old_value, props AS new_value
FROM events"""

# a choice that nobody of a group value chose has no row
ORACLE["survey_prop_packed"] = f"SELECT * FROM ({ORACLE['survey_prop_select_multiple']}) WHERE n > 0"

ORACLE["audit_attachments"] = ORACLE["audit_log"].replace("user_id AS uuid", "event_type AS uuid")

ORACLE["interview_duration"] = """
WITH a AS (SELECT user_id AS uuid, epoch_us(ts) // 1000 AS s,
                  epoch_us(ts) // 1000 + CAST(round(value * 1000) AS BIGINT) AS e
           FROM events WHERE NOT contains(event_type, 'error')),
summ AS (SELECT uuid, coalesce(sum((e - s) / 60000.0), 0.0) AS d, min(s) AS st FROM a GROUP BY uuid)
SELECT c.c_custkey AS uuid, c.c_name, c.c_nationkey, round(c.c_acctbal, 6) AS c_acctbal,
       c.c_mktsegment, round(s.d, 6) AS interview_duration, s.st AS interview_start
FROM customer c LEFT JOIN summ s ON c.c_custkey = s.uuid"""

ORACLE["split_repeats"] = f"""
SELECT l.l_orderkey AS o_orderkey,
       CAST(row_number() OVER (PARTITION BY l.l_orderkey
                               ORDER BY {', '.join('l.' + c for c in LINE_FIELDS)}) AS INTEGER)
         AS _index,
       {', '.join(('round(l.' + c + ', 6) AS ' + c) if c in ('l_quantity', 'l_extendedprice')
                  else 'l.' + c for c in LINE_FIELDS)}
FROM lineitem l WHERE l.l_orderkey IN (SELECT o_orderkey FROM orders)"""


def _sq(v) -> str:
    """SQL literal."""
    if v is None:
        return "NULL"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("'", "''") + "'"


def _clean_ctes() -> str:
    form = ", ".join("(" + ", ".join(_sq(x) for x in row) + ")" for row in CLEAN_FORM)
    return f"""form(pos, type, name, relevant) AS (VALUES {form}),
ch AS (
  SELECT list_name, name, row_number() OVER (PARTITION BY list_name ORDER BY is_other, name) AS pos
  FROM (SELECT DISTINCT 'segment_list' AS list_name, c_mktsegment AS name, 0 AS is_other
        FROM customer WHERE c_mktsegment <> {_sq(MISSING_SEGMENT)}
        UNION ALL SELECT DISTINCT 'type_list', p_type, 0 FROM part
        UNION ALL SELECT 'segment_list', 'other', 1
        UNION ALL SELECT 'type_list', 'Other', 1) u),
f2 AS (SELECT * FROM form WHERE NOT coalesce(regexp_matches(type, '(begin|end)(\\s+|_)group'), false)),
oq AS (SELECT name AS other_question,
              nullif(regexp_extract(relevant, '\\{{([A-Za-z0-9_]+)\\}}', 1), '') AS parent_question
       FROM f2 WHERE type = 'text' AND regexp_matches(relevant, {_sq("(?i)'other'")})),
par AS (SELECT name, string_split(type, ' ')[2] AS list_name FROM f2
        WHERE contains(type, 'select') AND name IN (SELECT parent_question FROM oq)),
orows AS (SELECT oq.other_question, c.pos, c.name AS choice
          FROM par JOIN oq ON par.name = oq.parent_question JOIN ch c ON c.list_name = par.list_name
          WHERE c.name NOT IN ('other', 'Other') OR c.name IS NULL),
fixed(name, pos, value) AS (VALUES {", ".join(f"({_sq(n)}, {i + 1}, {_sq(v)})"
                                                for n, vals in FIXED_LISTS.items()
                                                for i, v in enumerate(vals))}),
sel AS (SELECT name, string_split(type, ' ')[2] AS list_name FROM f2 WHERE contains(type, 'select')),
perq AS (SELECT s.name, row_number() OVER (PARTITION BY s.name, s.list_name ORDER BY c.pos, c.name) AS pos,
                c.name AS value
         FROM sel s JOIN ch c ON c.list_name = s.list_name)"""


ORACLE["other_options"] = f"""
WITH {_clean_ctes()}
SELECT other_question, string_agg(choice, ';' || chr(10) ORDER BY pos, choice) AS choices
FROM orows GROUP BY other_question"""

ORACLE["choice_lists"] = f"""
WITH {_clean_ctes()},
oth AS (SELECT other_question AS name,
               row_number() OVER (PARTITION BY other_question ORDER BY pos, choice) AS pos, choice AS value
        FROM orows)
SELECT name, CAST(pos AS INTEGER) AS pos, value FROM fixed
UNION ALL
SELECT DISTINCT name, CAST(pos AS INTEGER), value FROM (SELECT * FROM perq UNION ALL SELECT * FROM oth) x"""

ORACLE["validate_cleaning_log"] = f"""
WITH {_clean_ctes()},
lists AS (SELECT name, value FROM fixed UNION ALL SELECT name, value FROM perq),
names AS (SELECT DISTINCT name FROM lists),
log AS (
  SELECT CAST(c_custkey AS VARCHAR) AS uuid, 'c_mktsegment' AS question,
         CASE WHEN c_acctbal < 0 THEN 'blank_response' ELSE 'change_response' END AS change_type,
         'check' AS issue, c_mktsegment AS new_value FROM customer
  UNION ALL
  SELECT CAST(p_partkey AS VARCHAR), 'p_type/' || lower(p_type), 'change_response', 'check',
         CASE WHEN p_size > 25 THEN '1' ELSE 'TRUE' END FROM part
  UNION ALL SELECT 'all', 'c_mktsegment', 'no_action', 'check', n_name FROM nation
  UNION ALL SELECT CAST(r_regionkey AS VARCHAR), 'c_nationkey', 'delete', 'check', r_name FROM region),
r AS (SELECT l.*,
             CASE WHEN n.name IS NOT NULL AND coalesce(l.uuid <> 'all', false) THEN l.question
                  WHEN (contains(l.question, '.') OR contains(l.question, '/'))
                       AND coalesce(l.uuid <> 'all', false) THEN 'binaries_sm_options_lgl' END AS allowed_list
      FROM log l LEFT JOIN names n ON l.question = n.name)
SELECT r.uuid, r.question, r.change_type, r.issue, r.new_value, r.allowed_list,
       CASE WHEN r.allowed_list IS NOT NULL THEN
         EXISTS (SELECT 1 FROM lists x WHERE x.name = r.allowed_list AND x.value = r.new_value) END
         AS new_value_ok,
       coalesce(r.change_type IN ({", ".join(_sq(c) for c in CHANGE_TYPES)}), false) AS change_type_ok
FROM r"""

ORACLE["recode_others"] = f"""
WITH {_clean_ctes()},
oqs AS (SELECT name, nullif(regexp_extract(relevant, '\\{{([A-Za-z0-9_]+)\\}}', 1), '') AS parent_question
        FROM form WHERE type = 'text'
        AND regexp_matches(relevant, {_sq(r"(?i)(selected\([^)]*'other'\)|=\s*'other')")})),
sl AS (SELECT name, regexp_split_to_array(trim(type), ' +')[2] AS list_name,
              regexp_split_to_array(trim(type), ' +')[1] AS select_type
       FROM form WHERE contains(type, 'select')),
qa AS (SELECT DISTINCT s.name AS parent, c.name AS answer
       FROM sl s JOIN ch c ON c.list_name = s.list_name
       WHERE s.name IN (SELECT parent_question FROM oqs)),
log AS (
  SELECT CAST(c_custkey AS VARCHAR) AS uuid, 'c_mktsegment_other' AS question,
         'change_response' AS change_type, 'recode other' AS issue, c_mktsegment AS new_value FROM customer
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'p_type_other', 'change_response', 'recode other', p_type
  FROM part
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'c_nationkey', 'change_response', 'outlier',
                   CAST(c_nationkey AS VARCHAR) FROM customer
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'c_mktsegment', 'change_response', 'typo', p_name FROM part),
rc AS (SELECT l.*, o.parent_question FROM log l LEFT JOIN oqs o ON l.question = o.name
       WHERE l.change_type = 'change_response' AND l.issue = 'recode other'),
valid AS (SELECT rc.*, s.select_type FROM rc
          JOIN qa ON rc.parent_question = qa.parent AND rc.new_value = qa.answer
          LEFT JOIN sl s ON rc.parent_question = s.name),
nw AS (
  SELECT uuid, parent_question || '/' || new_value AS question, change_type, '1' AS new_value
  FROM valid WHERE select_type = 'select_multiple'
  UNION ALL SELECT uuid, parent_question || '/other', change_type, '0' FROM valid
  WHERE select_type = 'select_multiple'
  UNION ALL SELECT uuid, question, change_type, NULL FROM valid WHERE select_type = 'select_multiple'
  UNION ALL SELECT uuid, parent_question, change_type, new_value FROM valid WHERE select_type = 'select_one'
  UNION ALL SELECT uuid, question, change_type, NULL FROM valid WHERE select_type = 'select_one')
SELECT uuid, question, change_type, issue, new_value FROM log l
WHERE NOT (l.uuid IN (SELECT uuid FROM nw) AND l.question IN (SELECT question FROM nw)
           AND l.change_type = 'change_response')
UNION ALL
SELECT uuid, question, change_type, CAST(NULL AS VARCHAR), new_value FROM nw"""


def _tracker_sql() -> str:
    raw_cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                "l_extendedprice", "l_discount", "l_tax", "l_linestatus", "l_shipdate"]
    clean_cols = [c for c in raw_cols if c != "l_tax"] + ["l_net"]

    def manifest(src, cols):
        return " UNION ALL ".join(
            f"SELECT l_returnflag AS dataset, '{c}' AS variable FROM {src} GROUP BY l_returnflag "
            f"HAVING count({c}) > 0" for c in cols)
    return f"""
WITH cl AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
                   CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_discount END AS l_discount,
                   l_returnflag, l_linestatus, l_shipdate,
                   l_extendedprice * (1 - l_discount) AS l_net FROM lineitem),
raw AS ({manifest('lineitem', raw_cols)}),
cln AS ({manifest('cl', clean_cols)})
SELECT dataset, variable AS Variable, 'remove' AS Action, '' AS Rationale FROM raw
WHERE (dataset, variable) NOT IN (SELECT dataset, variable FROM cln)
UNION ALL
SELECT dataset, variable, 'added', '' FROM cln
WHERE (dataset, variable) NOT IN (SELECT dataset, variable FROM raw)"""


ORACLE["variable_tracker"] = _tracker_sql()


ORACLE["choice_lists_wide"] = f"""
WITH {_clean_ctes()},
oth AS (SELECT other_question AS name,
               row_number() OVER (PARTITION BY other_question ORDER BY pos, choice) AS pos, choice AS value
        FROM orows),
lst AS (SELECT name, CAST(pos AS INTEGER) AS pos, value FROM fixed
        UNION ALL
        SELECT DISTINCT name, CAST(pos AS INTEGER), value
        FROM (SELECT * FROM perq UNION ALL SELECT * FROM oth) x)
SELECT pos, {", ".join(f"max(CASE WHEN name = '{n}' THEN value END) AS {n}" for n in CHOICE_LIST_NAMES)}
FROM lst GROUP BY pos"""

ORACLE["recode_others_pair"] = ORACLE["recode_others"].replace(
    """WHERE NOT (l.uuid IN (SELECT uuid FROM nw) AND l.question IN (SELECT question FROM nw)
           AND l.change_type = 'change_response')""",
    """WHERE NOT ((l.uuid, l.question) IN (SELECT uuid, question FROM nw)
           AND l.change_type = 'change_response')""")

ORACLE["interview_audit"] = """
SELECT user_id AS uuid, event_type AS node, epoch_us(ts) // 1000 AS start,
       epoch_us(ts) // 1000 + CAST(round(value * 1000) AS BIGINT) AS "end",
       round(CAST(round(value * 1000) AS BIGINT) / 60000.0, 6) AS metadata_duration
FROM events WHERE NOT contains(event_type, 'error')"""

ORACLE["run_summary"] = """
WITH cols AS (SELECT column_name FROM information_schema.columns WHERE table_name = 'lineitem')
SELECT column_name AS "group", column_name AS safe_name, true AS success, true AS write_ok,
       CAST(NULL AS VARCHAR) AS error
FROM cols WHERE column_name IN ('l_returnflag', 'l_linestatus')
UNION ALL
SELECT CAST(NULL AS VARCHAR), 'Overall', false, false,
       'analysis mean of no_such_column dropped: variable not in data'
WHERE 'no_such_column' NOT IN (SELECT column_name FROM cols)"""

ORACLE["variable_tracker_schema"] = """
WITH ds AS (SELECT DISTINCT o_orderpriority AS dataset FROM orders),
rawc AS (SELECT column_name AS variable FROM information_schema.columns
         WHERE table_name = 'orders' AND column_name <> 'o_orderpriority'),
cleanc AS (SELECT variable FROM rawc WHERE variable <> 'o_orderstatus'
           UNION ALL SELECT 'o_year'),
raw AS (SELECT dataset, variable FROM ds, rawc),
cln AS (SELECT dataset, variable FROM ds, cleanc)
SELECT dataset, variable AS Variable, 'remove' AS Action, '' AS Rationale FROM raw
WHERE (dataset, variable) NOT IN (SELECT dataset, variable FROM cln)
UNION ALL
SELECT dataset, variable, 'added', '' FROM cln
WHERE (dataset, variable) NOT IN (SELECT dataset, variable FROM raw)"""

ORACLE["survey_all_types"] = _union(
    oracle.survey_prop_sql("part", None, "p_size", "p_name", ["p_brand"], multi=True),
    oracle.survey_prop_sql("part", None, "p_size", "p_type", ["p_brand"]),
    oracle.survey_mean_sql("part", None, "p_size", "p_retailprice", ["p_brand"]),
    oracle.survey_median_sql("part", None, "p_size", "p_retailprice", ["p_brand"]))

_WIDE_VALUES = [f"{g}_{c}" for g in ("Overall", "A", "N", "R") for c in ("stat", "stat_upp", "stat_low", "n")]
ORACLE["results_csv"] = f"""
SELECT analysis_type, analysis_var, coalesce(analysis_var_value, 'NA') AS analysis_var_value,
       {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _WIDE_VALUES)}
FROM ({ORACLE["results_wide"]})"""

ORACLE["results_tiles"] = f"""
WITH r AS ({oracle.survey_prop_sql("customer", None, None, "c_mktsegment", ["c_nationkey"])}),
h AS (SELECT group_var_value AS v, row_number() OVER (ORDER BY group_var_value) AS k
      FROM (SELECT DISTINCT group_var_value FROM r WHERE group_var IS NOT NULL)),
p AS (SELECT r.*, coalesce(h.k, 0) AS k FROM r LEFT JOIN h ON r.group_var IS NOT NULL AND h.v = r.group_var_value)
SELECT CAST(k // 8 AS INTEGER) AS tile, analysis_type, analysis_var, analysis_var_value,
       {", ".join(f"max(CASE WHEN k % 8 = {i} THEN {c} END) AS b{i}_{c}" for i in range(8) for c in ("stat", "n"))}
FROM p GROUP BY ALL"""

ORACLE["results_rerun"] = """
WITH v AS (SELECT count(DISTINCT l_linestatus) + 1 AS k FROM lineitem)
SELECT 1 AS run, 'l_returnflag' AS "group", 'l_returnflag' AS safe_name, true AS success, true AS write_ok,
       CAST(NULL AS VARCHAR) AS error, k AS rows_left FROM v
UNION ALL SELECT 2, NULL, 'Overall', false, false, 'exists', k FROM v
UNION ALL SELECT 3, 'l_returnflag', 'l_returnflag', false, false, 'columns', k FROM v
UNION ALL SELECT 4, 'l_returnflag', 'l_returnflag', true, true, NULL, 1 FROM v"""

ORACLE["form_versions"] = """
SELECT 'c' || c_custkey AS uuid, 'v1' AS form_version, CAST(c_nationkey AS VARCHAR) AS area, round(c_acctbal, 6) AS amount,
       c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS BIGINT) AS size, CAST(NULL AS DOUBLE) AS price,
       CAST(NULL AS VARCHAR) AS brand, CAST(NULL AS VARCHAR) AS first_word, CAST(NULL AS INTEGER) AS n_words FROM customer
UNION ALL SELECT 's' || s_suppkey, 'v2', 'area ' || s_nationkey, CAST(s_suppkey AS DOUBLE), NULL, s_name, NULL, NULL, NULL, NULL, NULL
FROM supplier
UNION ALL SELECT 'p' || p_partkey, 'v3', NULL, NULL, NULL, NULL, p_size, round(p_retailprice, 6), p_brand,
       string_split(p_name, ' ')[1], CAST(len(string_split(p_name, ' ')) AS INTEGER) FROM part"""

ORACLE["cleaning_log_tables"] = f"""
SELECT 'cleaning_log' AS name, 8 AS n_columns, count(*) AS n_rows, count(*) FILTER (NOT new_value_ok) AS n_flagged
FROM ({ORACLE["validate_cleaning_log"]})
UNION ALL SELECT 'clean_data', (SELECT CAST(count(*) AS INTEGER) FROM information_schema.columns WHERE table_name = 'customer'),
       count(*), 0 FROM customer
UNION ALL SELECT 'validation_rules', CAST(count(DISTINCT name) + 1 AS INTEGER), max(pos), 0
FROM ({ORACLE["choice_lists"]}) WHERE NOT ends_with(name, '_other')
UNION ALL SELECT 'readme', 2, 4, 0"""
