"""Cleaning-log helpers (W13-W17).

The form's survey and choices sheets are small tables; the cleaning log and
column manifests can be data-sized. Every step is a join, a filter or an
``explode``: log rows are never paired with each other, and form tables are
joined by key (AQE broadcasts them after measuring).

Form tables: survey ``(type, name, relevant)``; choices ``(list_name, name)``
with an optional ``pos`` giving sheet order (else order by name).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.joins import lookup_join
from ..functions.columns import q, require_columns
from ..session import ensure_checkpoint_dir

# Allowed change types, the two binary answer lists, the
# patterns that find "other" questions, group markers and {name} references,
# and the literal "other" answers left out of option lists.
CHANGE_TYPES = ["change_response", "blank_response", "remove_survey", "no_action"]
FIXED_LISTS = {
    "change_type_validation": CHANGE_TYPES,
    "binaries_sm_options_lgl": ["FALSE", "TRUE"],
    "binaries_sm_options_num": ["0", "1"],
}
OTHER_LOOSE = r"(?i)'other'"
OTHER_STRICT = r"(?i)(selected\([^)]*'other'\)|=\s*'other')"
GROUP_MARKER = r"(begin|end)(\s+|_)group"
NAME_IN_BRACES = r"\{([A-Za-z0-9_]+)\}"
LITERAL_OTHERS = ["other", "Other"]
LIST_SEP = ";\n"


# --- W13 variable tracker ----------------------------------------------------

def column_manifest(df: DataFrame, dataset_col: str | None = None, dataset: str = "data",
                    present: str = "schema") -> DataFrame:
    """(dataset, variable) for the columns of each dataset.

    ``present='schema'`` lists every column (as comparing column names
    does); with ``dataset_col`` every dataset value gets every column, by an
    ``explode`` over the distinct datasets. ``present='values'`` lists only
    columns holding at least one non-NULL value in that dataset (JSON
    exports drop empty answers, so an all-NULL column is an absent column):
    one grouped count, partially aggregated."""
    if present not in ("schema", "values"):
        raise ValueError("present must be 'schema' or 'values'")
    cols = [c for c in df.columns if c != dataset_col]
    key = F.col(q(dataset_col)).cast("string") if dataset_col else F.lit(dataset)
    if present == "schema":
        names = F.array(*[F.lit(c) for c in cols])
        base = df.select(key.alias("dataset")).distinct() if dataset_col else \
            df.sparkSession.range(1).select(F.lit(dataset).alias("dataset"))
        return base.select("dataset", F.explode(names).alias("variable"))
    counts = df.groupBy(key.alias("dataset")).agg(
        *[F.count(F.col(q(c))).alias(f"__n{i}") for i, c in enumerate(cols)])
    stacked = F.inline(F.array(*[F.struct(F.lit(c).alias("variable"),
                                          F.col(f"__n{i}").alias("n"))
                                 for i, c in enumerate(cols)]))
    return counts.select("dataset", stacked).where(F.col("n") > 0).select("dataset", "variable")


def variable_tracker(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Columns removed (only in raw) and added (only in clean), per dataset:
    (dataset, Variable, Action, Rationale). Inputs are manifests
    (dataset, variable); see :func:`column_manifest`."""
    require_columns(raw, ["dataset", "variable"], "raw manifest")
    require_columns(clean, ["dataset", "variable"], "clean manifest")
    # one union and one grouped pass instead of two anti-joins, so each
    # manifest is computed once
    sides = (raw.select("dataset", "variable", F.lit(1).alias("r"), F.lit(0).alias("c"))
                .unionByName(clean.select("dataset", "variable", F.lit(0).alias("r"),
                                          F.lit(1).alias("c"))))
    both = sides.groupBy("dataset", "variable").agg(F.max("r").alias("r"), F.max("c").alias("c"))
    action = (F.when((F.col("r") == 1) & (F.col("c") == 0), F.lit("remove"))
               .when((F.col("r") == 0) & (F.col("c") == 1), F.lit("added")))
    return (both.select("dataset", F.col("variable").alias("Variable"), action.alias("Action"),
                        F.lit("").alias("Rationale"))
                .where(F.col("Action").isNotNull()))


# --- form helpers --------------------------------------------------------------

def _nth_token(c: Column, i: int, pattern: str = " +") -> Column:
    return F.get(F.split(F.trim(c), pattern), i)


def other_questions(form: DataFrame, strict: bool) -> DataFrame:
    """Free-text 'other, specify' questions and the parent they depend on."""
    require_columns(form, ["type", "name", "relevant"], "form")
    pat = OTHER_STRICT if strict else OTHER_LOOSE
    parent = F.nullif(F.regexp_extract(F.col("relevant"), NAME_IN_BRACES, 1), F.lit(""))
    return (form.where((F.col("type") == "text") & F.col("relevant").rlike(pat))
                .select(F.col("name").alias("other_question"), parent.alias("parent_question")))


def select_questions(form: DataFrame, single_blank: bool = False) -> DataFrame:
    """Select questions with list name and kind (select_one / select_multiple)."""
    pat = " " if single_blank else " +"
    t = F.col("type")
    if single_blank:
        lst = F.get(F.split(t, pat), 1)
    else:
        lst = _nth_token(t, 1, pat)
    return (form.where(t.contains("select"))
                .select("name", lst.alias("list_name"),
                        _nth_token(t, 0, pat).alias("select_type")))


def _ordered_choices(choices: DataFrame) -> DataFrame:
    require_columns(choices, ["list_name", "name"], "choices")
    pos = F.col("pos") if "pos" in choices.columns else F.lit(None).cast("int")
    return choices.select("list_name", F.col("name").cast("string").alias("choice"),
                          pos.alias("pos"))


def _packed(items: Column) -> Column:
    """array<struct<pos, choice>> -> choices joined by ';\\n' in pos order."""
    return F.array_join(F.transform(F.array_sort(items), lambda x: x["choice"]), LIST_SEP)


# --- W14 other options -------------------------------------------------------------

def other_options(form: DataFrame, choices: DataFrame, strict: bool = False) -> DataFrame:
    """(other_question, choices): the parent's choices, except the literal
    other answers, joined by ';\\n' in sheet order. Parents without choices
    give no row. Groups hold one list each (form-sized). ``strict`` raises
    when no 'other' question with choices is found (one small job)."""
    oq = other_questions(form, strict=False)
    parents = select_questions(form, single_blank=True).join(
        oq.select(F.col("parent_question").alias("name")).distinct(), "name", "left_semi")
    linked = parents.join(oq, parents["name"] == oq["parent_question"], "left")
    ch = _ordered_choices(choices)
    rows = (linked.join(ch, "list_name")
                  .where(~F.col("choice").isin(*LITERAL_OTHERS) | F.col("choice").isNull()))
    out = (rows.groupBy("other_question")
               .agg(_packed(F.collect_list(F.struct("pos", "choice"))).alias("choices")))
    if strict and out.isEmpty():
        raise ValueError("no 'other' questions with matching choices found")
    return out


# --- W15 choice lists ------------------------------------------------------------------

def choice_lists(choices: DataFrame, form: DataFrame, others: bool = False) -> DataFrame:
    """Allowed values per list, long: (name, pos, value), pos 1-based.

    Lists: the fixed change-type and binary lists; every select question
    (group markers removed) with its list's choices in sheet order; with
    ``others``, every 'other' question with its parent's choices."""
    spark = choices.sparkSession
    form = form.where(~F.coalesce(F.col("type").rlike(GROUP_MARKER), F.lit(False)))
    if others:  # the sheet is read by both list builders: store it once
        ensure_checkpoint_dir(spark)
        choices = choices.checkpoint(eager=True)
    fixed = spark.createDataFrame(
        [(name, i + 1, v) for name, vals in FIXED_LISTS.items() for i, v in enumerate(vals)],
        "name string, pos int, value string")
    sel = select_questions(form, single_blank=True).select("name", "list_name")
    ch = _ordered_choices(choices)
    per_q = (sel.join(ch, "list_name")
                .groupBy("name", "list_name")
                .agg(F.array_sort(F.collect_list(F.struct("pos", "choice"))).alias("items"))
                .select("name", F.transform("items", lambda x: x["choice"]).alias("values")))
    lists = per_q
    if others:
        oo = other_options(form, choices)
        lists = lists.unionByName(oo.select(F.col("other_question").alias("name"),
                                            F.split("choices", LIST_SEP).alias("values")))
    lists = lists.dropDuplicates(["name", "values"])
    long = lists.select("name", F.posexplode("values").alias("p", "value")).select(
        "name", (F.col("p") + 1).alias("pos"), "value")
    return fixed.unionByName(long)


def choice_lists_wide(long: DataFrame, names: list[str] | None = None) -> DataFrame:
    """One column per list, one row per position, padded with NULL."""
    g = long.groupBy("pos")
    g = g.pivot("name", names) if names is not None else g.pivot("name")
    return g.agg(F.first("value")).orderBy("pos")


# --- W16 cleaning-log validation -------------------------------------------------

def validate_cleaning_log(log: DataFrame, form: DataFrame, choices: DataFrame,
                          sm_dropdown_type: str | None = None, use_others: bool = False,
                          change_type_col: str = "change_type") -> DataFrame:
    """Attach to each log row the list its new value must come from and
    flag the values. First rule that applies: (1) the question is a list
    name and uuid is not 'all' -> that list; (2) the question holds '.' or
    '/' and uuid is not 'all' -> the binary list (numeric when
    ``sm_dropdown_type='numerical'``); (3) no list. Adds ``allowed_list``,
    ``new_value_ok`` (NULL without a list) and ``change_type_ok``."""
    require_columns(log, ["uuid", "question", "new_value", change_type_col], "cleaning log")
    if sm_dropdown_type is not None and sm_dropdown_type.lower() not in ("logical", "numerical"):
        raise ValueError("sm_dropdown_type must be 'logical' or 'numerical'")
    binary = ("binaries_sm_options_num" if (sm_dropdown_type or "").lower() == "numerical"
              else "binaries_sm_options_lgl")
    # form-sized, used three times below: stored once
    ensure_checkpoint_dir(log.sparkSession)
    lists = choice_lists(choices, form, others=use_others).checkpoint(eager=True)
    names = lists.where("name IS NOT NULL").select(F.col("name").alias("__ln")).distinct()
    pairs = (lists.where("name IS NOT NULL AND value IS NOT NULL")
                  .select(F.col("name").alias("__pn"), F.col("value").alias("__pv")).distinct())
    ct = lists.where((F.col("name") == "change_type_validation") & F.col("value").isNotNull()).select(
        F.col("value").alias("__ct"))
    not_all = F.coalesce(F.col("uuid").cast("string") != "all", F.lit(False))
    # a few questions hold most of the log: the lists' size is checked, they go to the rows
    flagged = lookup_join(log, names, [("question", "__ln")], "left")
    rule = (F.when(F.col("__ln").isNotNull() & not_all, F.col("question"))
             .when((F.col("question").contains(".") | F.col("question").contains("/")) & not_all,
                   F.lit(binary)))
    flagged = flagged.withColumn("allowed_list", rule).drop("__ln")
    flagged = lookup_join(flagged.withColumn("__nv", F.col("new_value").cast("string")), pairs,
                          [("allowed_list", "__pn"), ("__nv", "__pv")], "left")
    flagged = lookup_join(flagged, ct, [(change_type_col, "__ct")], "left")
    return flagged.select(
        *[F.col(q(c)) for c in log.columns], "allowed_list",
        F.when(F.col("allowed_list").isNotNull(), F.col("__pn").isNotNull()).alias("new_value_ok"),
        F.col("__ct").isNotNull().alias("change_type_ok"))


# --- W17 recode others -------------------------------------------------------------------

def recode_others(form: DataFrame, choices: DataFrame, log: DataFrame, sm_sep: str = "/",
                  other_string: str = "other", match: str = "independent") -> DataFrame:
    """Rewrite valid 'recode other' log rows into changes of the parent.

    A log row with change_type 'change_response' and issue 'recode other'
    on an 'other' text question is valid when its new value is a choice of
    the parent question. It becomes, for a select_multiple parent:
    ``parent/new_value -> '1'``, ``parent/<other_string> -> '0'``, text
    question -> NULL; for a select_one parent: ``parent -> new_value``, text
    question -> NULL. Existing change_response rows are removed when their
    uuid is among the new rows' uuids and their question among the new
    rows' questions (``match='independent'``, two separate memberships), or
    when the (uuid, question) pair is (``match='pair'``). The new rows are
    appended; other log columns are NULL on them.
    """
    require_columns(log, ["uuid", "question", "change_type", "issue", "new_value"], "cleaning log")
    if match not in ("independent", "pair"):
        raise ValueError("match must be 'independent' or 'pair'")
    oq = other_questions(form, strict=True)
    sel = select_questions(form)
    parents = sel.join(oq.select(F.col("parent_question").alias("name")).distinct(), "name",
                       "left_semi")
    ch = _ordered_choices(choices)
    legal = (parents.join(ch, "list_name")
                    .select(F.col("name").alias("__qa_parent"), F.col("choice").alias("__qa_answer"))
                    .distinct())
    kinds = sel.select(F.col("name").alias("__sn"), "select_type")
    # the legal recodes of every text question: form-sized, stored, and looked
    # up by the log rows, so a question with most of the log is no hot key and
    # rows that cannot match travel nowhere
    ensure_checkpoint_dir(log.sparkSession)
    recodes = (oq.join(legal, F.col("parent_question") == F.col("__qa_parent"))
                 .join(kinds, F.col("parent_question") == F.col("__sn"), "left")
                 .where(F.col("other_question").isNotNull() & F.col("__qa_answer").isNotNull())
                 .select("other_question", "parent_question", "__qa_answer", "select_type").checkpoint(eager=True))
    rc = log.where((F.col("change_type") == "change_response") & (F.col("issue") == "recode other"))
    valid = lookup_join(rc.withColumn("__nv", F.col("new_value").cast("string")), recodes,
                        [("question", "other_question"), ("__nv", "__qa_answer")])

    def change(question: Column, value: Column) -> Column:
        return F.struct(F.col("uuid").alias("uuid"), question.cast("string").alias("question"),
                        F.col("change_type").alias("change_type"),
                        value.cast("string").alias("new_value"))

    parent, text_q = F.col("parent_question"), F.col("question")
    multi = F.array(change(F.concat(parent, F.lit(sm_sep), F.col("new_value").cast("string")),
                           F.lit("1")),
                    change(F.concat(parent, F.lit(sm_sep), F.lit(other_string)), F.lit("0")),
                    change(text_q, F.lit(None)))
    single = F.array(change(parent, F.col("new_value")), change(text_q, F.lit(None)))
    changes = F.when(F.col("select_type") == "select_multiple", multi) \
               .when(F.col("select_type") == "select_one", single)
    # stored once: the rows are appended and also drive both memberships
    new_rows = valid.select(F.explode(changes).alias("c")).select("c.*").checkpoint(eager=True)

    if match == "pair":
        keys = (new_rows.select(F.col("uuid").alias("__u"), F.col("question").alias("__q"))
                        .distinct().withColumn("__hit", F.lit(True)))
        kept = log.join(keys, F.col("uuid").eqNullSafe(F.col("__u"))
                        & F.col("question").eqNullSafe(F.col("__q")), "left")
        hit = F.coalesce(F.col("__hit"), F.lit(False))
        kept = kept.where(~(hit & (F.col("change_type") == "change_response")))
    else:
        # few questions are recoded: they go to the rows, and only their
        # change_response rows are asked for their uuid
        qq = new_rows.select(F.col("question").alias("__q")).distinct().withColumn("__hq", F.lit(True)).checkpoint(eager=True)
        uu = new_rows.select(F.col("uuid").alias("__u")).distinct()
        asked = F.coalesce(F.col("__hq") & (F.col("change_type") == "change_response"), F.lit(False))
        marked = lookup_join(log, qq, [("question", "__q")], "left").withColumn("__asked", asked)
        kept = (marked.where(~F.col("__asked")).unionByName(
            marked.where("__asked").join(uu, F.col("uuid").eqNullSafe(F.col("__u")), "left_anti")))
    kept = kept.select(*[F.col(q(c)) for c in log.columns])
    if "new_value" in kept.columns:
        kept = kept.withColumn("new_value", F.col("new_value").cast("string"))
    return kept.unionByName(new_rows, allowMissingColumns=True)
