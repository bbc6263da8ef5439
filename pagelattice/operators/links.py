"""Linking parameters to topic files, the coverage index, rule files and integrity findings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagelattice.functions import registers as R
from pagelattice.functions import text as X
from pagelattice.sources.tables import kept


def topic_entries(knowledge: DataFrame) -> DataFrame:
    """manual_id, tier (id or group), key, ref, score of what each topic file offers to parameters."""
    ref = X.section_ref(F.col("section_ref"), F.col("rel_path"))
    base = knowledge.select("manual_id", "know_id", ref.alias("ref"), "related_parameters", F.concat_ws(" ", ref, "title").alias("hints"), R.rank_of(F.col("content_completeness"), R.COMPLETENESS).alias("c"), R.rank_of(F.col("extraction_confidence"), R.CONFIDENCE).alias("f"))
    ids = base.select("manual_id", "know_id", "ref", "c", "f", F.lit("id").alias("tier"), F.explode(F.transform("related_parameters", lambda x: F.upper(F.trim(x["id"])))).alias("key"))
    first = F.when(F.contains("ref", F.lit("/")), F.array(F.substring_index("ref", "/", 1))).otherwise(F.array().cast("array<string>"))
    groups = base.select("manual_id", "know_id", "ref", "c", "f", F.lit("group").alias("tier"), F.explode(F.array_union(first, X.group_codes(F.col("hints")))).alias("key"))
    return ids.unionByName(groups).filter(F.coalesce("key", F.lit("")) != "")


def best_refs(entries: DataFrame) -> DataFrame:
    """The best topic of each key: most complete, then most confident, then shortest, then first."""
    order = F.struct("c", "f", -F.length("ref"), -F.col("know_id"))
    return entries.groupBy("manual_id", "tier", "key").agg(F.max_by("ref", order).alias("ref"))


def dominant_refs(linked: DataFrame, least: int = 2) -> DataFrame:
    """The most frequent reference of each group of a manual, if at least `least` rows have it; ties: shortest, then first."""
    counts = linked.filter(F.col("ref").isNotNull() & (F.coalesce("group_id", F.lit("")) != "")).groupBy("manual_id", "group_id", "ref").agg(F.count("*").alias("n"), F.min("reg_id").alias("first"))
    top = counts.groupBy("manual_id", "group_id").agg(F.max_by(F.struct("ref", "n"), F.struct("n", -F.length("ref"), -F.col("first"))).alias("t"))
    return top.filter(F.col("t.n") >= least).select("manual_id", "group_id", F.col("t.ref").alias("dominant"))


def link_parameters(registers: DataFrame, knowledge: DataFrame) -> DataFrame:
    """reg_id, manual_id, group_id, old, ref, by: the topic of each parameter by its id, else its group, else its group's dominant one."""
    best = best_refs(topic_entries(knowledge))
    regs = registers.select("reg_id", "manual_id", F.lower(F.coalesce("group_id", F.lit(""))).alias("group_id"), F.upper(F.trim("param_id")).alias("pid"), F.col("knowledge_ref").alias("old"))
    by_id = best.filter("tier = 'id'").select("manual_id", F.col("key").alias("pid"), F.col("ref").alias("id_ref"))
    by_group = best.filter("tier = 'group'").select("manual_id", F.col("key").alias("group_id"), F.col("ref").alias("group_ref"))
    one = kept(regs.join(by_id, ["manual_id", "pid"], "left").join(by_group, ["manual_id", "group_id"], "left").withColumn("ref", F.coalesce("id_ref", "group_ref")))  # read twice
    two = one.join(dominant_refs(one), ["manual_id", "group_id"], "left")
    by = F.when(F.col("id_ref").isNotNull(), "id").when(F.col("group_ref").isNotNull(), "group").when(F.col("dominant").isNotNull(), "propagated")
    return two.select("reg_id", "manual_id", "group_id", "old", F.coalesce("ref", "dominant").alias("ref"), by.alias("by"))


def link_report(linked: DataFrame) -> DataFrame:
    """For each manual: rows changed, linked by id or group, propagated, and the share with a topic in percent."""
    one = lambda c: F.sum(F.when(c, 1).otherwise(0))
    return linked.groupBy("manual_id").agg(one(~F.col("old").eqNullSafe(F.col("ref"))).alias("n_changed"), one(F.coalesce(F.col("by").isin("id", "group"), F.lit(False))).alias("n_first_pass"), one(F.coalesce(F.col("by") == "propagated", F.lit(False))).alias("n_propagated"), F.round(F.count("ref") / F.count("*") * 100, 4).alias("coverage"))


def prune_report(pruned: DataFrame) -> DataFrame:
    """How many references were left out, and how many files are written again for it."""
    return pruned.agg(F.coalesce(F.sum("n_pruned"), F.lit(0)).alias("n_pruned"), F.count_if(F.col("n_pruned") > 0).alias("n_rewritten"))


def pruned_refs(knowledge: DataFrame, field: str = "see_also") -> DataFrame:
    """know_id, field (see_also or prerequisites) without references to files that the manual doesn't have, in order, and how many were left out."""
    rows = knowledge.select("know_id", "manual_id", F.posexplode(field).alias("pos", "r")).withColumn("r", X.ref_key(F.col("r")))
    files = knowledge.select("manual_id", F.regexp_replace("rel_path", r"\.md$", "").alias("r")).distinct()
    found = rows.join(files, ["manual_id", "r"], "left_semi").groupBy("know_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "r"))), lambda x: x["r"]).alias("kept"))
    out = knowledge.select("know_id", F.coalesce(F.col(field), F.array().cast("array<string>")).alias(field)).join(found, "know_id", "left")
    new = F.coalesce("kept", F.array().cast("array<string>"))
    return out.select("know_id", new.alias(field), F.greatest(F.lit(0), F.size(field) - F.size(new)).alias("n_pruned"))


def index_sections(knowledge: DataFrame) -> DataFrame:
    """The entry of each topic file in the index."""
    given = lambda c, d: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(c)).otherwise(d)
    return knowledge.select("know_id", "manual_id", F.col("rel_path").alias("path"), given("title", X.stem_title(F.col("rel_path"))).alias("title"), given("content_completeness", F.lit("partial")).alias("completeness"), given("extraction_confidence", F.lit("medium")).alias("confidence"), F.greatest(F.coalesce(F.size("related_parameters"), F.lit(0)), F.lit(0)).alias("parameter_count"))


def uncovered_groups(registers: DataFrame, knowledge: DataFrame) -> DataFrame:
    """Groups of a manual's parameters that no topic folder covers, neither whole nor by their first part, with their parameters."""
    covered = knowledge.select("manual_id", F.substring_index(F.regexp_replace("rel_path", r"\.md$", ""), "/", 1).alias("c")).distinct()
    groups = registers.filter(F.coalesce("group_id", F.lit("")) != "").groupBy("manual_id", "group_id").agg(F.count("*").alias("parameter_count"))
    whole = groups.join(covered.withColumnRenamed("c", "group_id"), ["manual_id", "group_id"], "left_anti")
    return whole.withColumn("c", F.substring_index("group_id", "/", 1)).join(covered, ["manual_id", "c"], "left_anti").select("manual_id", "group_id", "parameter_count")


def key_topics(knowledge: DataFrame, most: int = 20) -> DataFrame:
    """The first topics of each manual in the order of their path's parts; the cut is the feature (rule files list no more)."""
    parts = F.split("rel_path", "/")
    paths = knowledge.select("manual_id", "rel_path").distinct()
    return paths.withColumn("no", F.row_number().over(Window.partitionBy("manual_id").orderBy(parts))).filter(F.col("no") <= most)


def rule_texts(manuals: DataFrame, devices: DataFrame, topics: DataFrame) -> DataFrame:
    """The rule file of each manual's device: a description, the files it applies to, and the key topics."""
    lines = topics.groupBy("manual_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("no", "rel_path"))), lambda x: F.concat(F.lit("- `docs/knowledge/"), x["rel_path"], F.lit("`"))), "\n").alias("lines"))
    named = manuals.select("manual_id", "device_id").join(devices.select("device_id", "manufacturer", "model_name"), "device_id").join(lines, "manual_id", "left")
    who = F.concat_ws(" ", "manufacturer", "model_name")
    text = F.concat(F.lit('---\ndescription: "'), who, F.lit(' device reference"\nglobs:\n  - "**/'), X.model_glob(F.coalesce("model_name", F.lit(""))), F.lit('*"\nalwaysApply: false\n---\n\n## '), who, F.lit("\n\nKey topics:\n"), F.coalesce("lines", F.lit("- No knowledge files generated.")), F.lit("\n"))
    return named.select("manual_id", X.slug(who, "-", None).alias("model_slug"), text.alias("content"))


def appended_lines(existing: DataFrame, entries: DataFrame, key: str) -> DataFrame:
    """Lists of lines with the entries that they lack, in order."""
    e = entries.groupBy(key).agg(F.array_sort(F.collect_set("entry")).alias("new"))
    none = F.array().cast("array<string>")
    return existing.join(e, key, "full").select(key, F.array_union(F.coalesce("lines", none), F.coalesce("new", none)).alias("lines"))


def _finding(df: DataFrame, severity: str, rule: str, subject) -> DataFrame:
    return df.select("manual_id", F.lit(severity).alias("severity"), F.lit(rule).alias("rule"), subject.cast("string").alias("subject"))


def findings(registers: DataFrame, knowledge: DataFrame, images: DataFrame, totals: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """manual_id, severity (E or W), rule, subject of every breach of the integrity rules. totals: manual_id, total of an index.

    The rules that a register can break alone are one array for each row, so that the table is read for all of them at
    once. Bitfields without a layout are told only where registers has a column bit_layout, prerequisites where
    knowledge has one. groups: manual_id, group_id; manuals without listed groups have no unknown ones.
    """
    from pagelattice.operators.records import nth_of

    has_id = F.trim(F.coalesce("param_id", F.lit(""))) != ""
    good = registers.filter(has_id)
    files = knowledge.select("manual_id", F.regexp_replace("rel_path", r"\.md$", "").alias("r")).distinct()
    count = registers.groupBy("manual_id").agg(F.count("*").alias("n"))
    flat = lambda c: knowledge.select("manual_id", F.explode(c).alias("r"))
    subject = F.concat_ws(":", F.col("param_id"), F.col("reg_id"))
    zero_one = F.coalesce(F.regexp_replace("value_range", r"\s", "").isin("0-1", "0to1"), F.lit(False))
    valued = F.coalesce(F.size("value_map"), F.lit(0)) > 0
    is_bits = F.coalesce(F.col("data_type") == "bitfield", F.lit(False))
    own = [
        (~has_id, "E", "id", F.col("reg_id").cast("string")),
        (has_id & is_bits & valued, "W", "bitfield_with_values", subject),
        (has_id & valued & zero_one & (F.coalesce("data_type", F.lit("")) != "bool"), "W", "values_over_0_1", subject),
        (has_id & F.coalesce(F.trim("knowledge_ref") == "", F.lit(False)), "E", "blank_ref", subject),
    ]
    if "bit_layout" in registers.columns:
        own.append((has_id & is_bits & (F.coalesce(F.size("bit_layout"), F.lit(0)) <= 0), "E", "bitfield_without_layout", subject))
    broken = F.filter(F.array(*(F.when(c, F.struct(F.lit(s).alias("severity"), F.lit(r).alias("rule"), x.alias("subject"))) for c, s, r, x in own)), lambda x: x.isNotNull())
    out = [
        registers.select("manual_id", F.explode(broken).alias("f")).select("manual_id", "f.severity", "f.rule", "f.subject"),
        _finding(nth_of(good.select("manual_id", "param_id", "reg_id"), ["manual_id", "param_id"], ["reg_id"]), "E", "duplicate_id", subject),
        _finding(nth_of(good.filter("modbus.address is not null").select("manual_id", F.col("modbus.address").alias("a"), "param_id", "reg_id"), ["manual_id", "a"], ["reg_id"]), "E", "duplicate_address", subject),
        _finding(count.filter("n < 10"), "W", "few_parameters", F.col("n")),
        _finding(good.filter(F.trim("knowledge_ref") != "").join(files.select("manual_id").distinct(), "manual_id", "left_semi").select("manual_id", F.col("knowledge_ref").alias("r")).join(files, ["manual_id", "r"], "left_anti"), "W", "missing_topic", F.col("r")),
        _finding(flat(F.transform("diagrams", lambda d: d["filename"])).join(images.select("manual_id", F.col("filename").alias("r")).distinct(), ["manual_id", "r"], "left_anti"), "W", "missing_diagram", F.col("r")),
        _finding(flat(F.transform("related_parameters", lambda d: d["id"])).distinct().join(registers.select("manual_id", F.col("param_id").alias("r")).distinct(), ["manual_id", "r"], "left_anti"), "W", "missing_parameter", F.col("r")),
        _finding(count.join(totals, "manual_id").filter("n <> total"), "E", "index_total", F.col("total")),
    ]
    for field in ("see_also", "prerequisites"):
        if field in knowledge.columns:
            out.append(_finding(flat(field).join(files, ["manual_id", "r"], "left_anti"), "W", f"missing_{field}", F.col("r")))
    if groups is not None:
        listed = groups.select("manual_id").distinct()
        named = groups.select("manual_id", F.lower("group_id").alias("g")).distinct()  # group codes differ in case between tables
        out.append(_finding(good.filter(F.col("group_id").isNotNull()).join(listed, "manual_id", "left_semi").withColumn("g", F.lower("group_id")).join(named, ["manual_id", "g"], "left_anti"), "E", "unknown_group", subject))
    result = out[0]
    for x in out[1:]:
        result = result.unionByName(x)
    return result


def document_findings(documents: DataFrame, phase: int = 2) -> DataFrame:
    """path, severity, rule, subject of breaches that only a register document as loaded can show. documents: path, doc (JSON text, null if it is no mapping).

    Its parameters must be a list, each of them a mapping, and from phase 2 on a knowledge_ref must be a string or null.
    """
    tree = F.try_parse_json(F.coalesce("doc", F.lit("{}")))
    listed = documents.select("path", F.try_variant_get(tree, "$.parameters", "array<variant>").alias("p"), F.try_variant_get(tree, "$.parameters", "variant").alias("v"))
    is_list = F.coalesce(F.startswith(F.schema_of_variant("v"), F.lit("ARRAY")), F.lit(False))
    told = lambda df, rule, subject: df.select("path", F.lit("E").alias("severity"), F.lit(rule).alias("rule"), subject.cast("string").alias("subject"))
    each = listed.filter(is_list).select("path", F.posexplode("p").alias("pos", "x"))
    mapping = F.coalesce(F.startswith(F.schema_of_variant("x"), F.lit("OBJECT")), F.lit(False))
    out = told(listed.filter(~is_list), "parameters_no_list", F.lit("parameters")).unionByName(told(each.filter(~mapping), "parameter_no_mapping", F.col("pos")))
    if phase >= 2:
        ref = F.try_variant_get("x", "$.knowledge_ref", "variant")
        out = out.unionByName(told(each.filter(mapping & ref.isNotNull() & ~F.schema_of_variant(ref).isin("STRING", "VOID")), "ref_no_string", F.col("pos")))
    return out


def file_findings(manuals: DataFrame, indexes: DataFrame, rules: DataFrame) -> DataFrame:
    """manual_id, severity, rule, subject: manuals without an index, with one that is no mapping, or without a rule file.

    indexes: manual_id, doc (JSON text, null if unreadable); rules: manual_id, filename.
    """
    has = manuals.select("manual_id").distinct()
    device_rules = rules.filter(F.col("filename").rlike(r"^device-.*\.mdc$"))
    out = _finding(has.join(indexes, "manual_id", "left_anti"), "W", "index_missing", F.lit("_index.yaml"))
    out = out.unionByName(_finding(has.join(indexes.filter("doc is null"), "manual_id", "left_semi"), "W", "index_unreadable", F.lit("_index.yaml")))
    out = out.unionByName(_finding(has.join(rules, "manual_id", "left_anti"), "W", "rules_missing", F.lit("rules")))
    return out.unionByName(_finding(has.join(rules, "manual_id", "left_semi").join(device_rules, "manual_id", "left_anti"), "W", "device_rule_missing", F.lit("device-*.mdc")))


def ordered_findings(found: DataFrame) -> DataFrame:
    """Findings as a report lists them: errors first, then by rule, manual and subject."""
    return found.orderBy("severity", "rule", "manual_id", "subject")


def refine_targets(knowledge: DataFrame, force: bool = False) -> DataFrame:
    """The topic files that a second reading is for: of low confidence or stubs; with force, all."""
    return knowledge if force else knowledge.filter((F.col("extraction_confidence") == "low") | (F.col("content_completeness") == "stub"))


def accepted_parses(attempts: DataFrame, scope: str, *, threshold: float = 3.0, retries: bool = True) -> DataFrame:
    """The parse that stands for each scope: the first, or a forced one whose score is known and no lower, if the first called for a retry.

    attempts: scope, forced (boolean), score, attempt (orders them), and what is carried. A first parse calls for a retry
    if its score is known and below threshold.
    """
    rows = F.struct(*(c for c in attempts.columns if c != scope))
    by = attempts.groupBy(scope).agg(F.min_by(rows, F.when(~F.col("forced"), F.col("attempt"))).alias("first"), F.min_by(rows, F.when(F.col("forced"), F.col("attempt"))).alias("retry"))
    take = F.lit(retries) & (F.col("first.score") < threshold) & F.coalesce(F.col("retry.score") >= F.col("first.score"), F.lit(False))
    return by.select(scope, F.when(F.coalesce(take, F.lit(False)), F.col("retry")).otherwise(F.coalesce("first", "retry")).alias("r")).select(scope, "r.*")


def sampled(registers: DataFrame, k: int) -> DataFrame:
    """k rows drawn by the hash of their id: the same ones on any run."""
    return registers.orderBy(F.md5(F.col("reg_id").cast("string"))).limit(k)
