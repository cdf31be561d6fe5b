"""The contract of read-only probes: twelve tables of text for each probe, and the files that they name, checked by rules; each broken rule is a row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.text import normalize_timestamp_lines, parse_drc_categories
from millrace.lineage import written
from millrace.registry import query

#: The tables of a probe and their columns.
COLUMNS = {
    "pre_restore_state.tsv": "query status value error",
    "probe_metadata.tsv": "key type value",
    "command_probe.tsv": "command command_exists help_status required_tokens missing_tokens raw_help_file detail",
    "sdc_write_probe.tsv": "analysis view sequence status relative_file bytes detail",
    "candidate_paths.tsv": "analysis view hierarchy_group stable_rank slack_ns beginpoint endpoint driver_pin driver_inst driver_ref net source_path_index",
    "path_rejections.tsv": "analysis source_path_index slack_ns beginpoint endpoint reason detail",
    "lib_signatures.tsv": "reference lib_cell library input_pins output_functions signature status detail",
    "drive_families.tsv": "source_ref source_drive stem flavor tail variant_ref variant_drive active_copy_count signature_status equivalent_to_source",
    "selection_probe.tsv": "query status result_count values expected exact_match error",
    "report_probe.tsv": "report_command status relative_file bytes detail",
    "unsupported_apis.tsv": "capability detail",
    "artifact_manifest.tsv": "relative_file schema row_count bytes",
}
#: What must be there once, what values a field may have, what metadata must say, marks of the status file.
COMMANDS = ("write_sdc", "rcOut", "refinePlace", "ecoRoute", "optDesign")
SELECTIONS = ("get_db_selected_full_name", "get_db_selected_name", "dbGet_selected_name")
REPORTS = ("report_constraint", "verifyConnectivity", "verify_drc")
METADATA = ("schema", "purpose", "process_id", "tool_version", "baseline_dir", "top", "setup_view", "hold_view", "checkpoint", "design_mutations", "gold_eligible")
SAYS = {"schema": "innovus_readonly_probe.v1", "purpose": "calibration_only_never_gold"}
GROUPS, ANALYSES, WRITTEN = ("exp", "multiplier", "pipeline", "top_tree"), ("late", "early"), ("setup", "hold")
MARKS, COMPLETE = ("GOLD_ELIGIBLE=FALSE", "DESIGN_MUTATIONS=0"), "SFT_INNOVUS_READONLY_PROBE_COMPLETE"
DRIVE, DRC_LIMIT = r"^(.*)_X(\d+(?:P\d+)?)([A-Z]*)_(.+)$", 1_000_000
ORDER = ("endpoint", "beginpoint", "driver_pin", "driver_inst", "driver_ref", "net")
FINDING = "probe_id", "kind", "rule"


def _text(c: str) -> Column:
    return F.length(c) > 0


def _whole(c: str, least: int = 0) -> Column:
    return F.trim(F.col(c)).rlike(r"^[+-]?\d+$") & (F.trim(F.col(c)).try_cast("long") >= least)


def _number(c: str) -> Column:
    v = F.col(c).try_cast("double")
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))


def _flag(c: str) -> Column:
    return F.lower(c).isin("true", "1", "false", "0")


def _yes(c: str) -> Column:
    return F.coalesce(F.lower(c).isin("true", "1"), F.lit(False))


def _sure(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def _found(df: DataFrame, kind: str, rules: dict[str, Column]) -> DataFrame:
    """One finding for each row and rule that applies; unknown (null) applies to a rule of kind ``broken`` and not to one of ``unsupported``."""
    unknown = F.lit(kind == "broken")
    hit = F.array_compact(F.array(*[F.when(F.coalesce(test, unknown), F.lit(rule)) for rule, test in rules.items()]))
    return df.select("probe_id", F.lit(kind).alias("kind"), F.explode(hit).alias("rule"))


def _meet(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """A join that sorts both sides: rows of all probes look small by the size of the files behind them (long texts that repeat), but grow with the probes and must not be broadcast."""
    return left.join(right.hint("merge"), on, how)


def _exactly(probes: DataFrame, df: DataFrame, col: str, names: tuple[str, ...], rule: str, others: bool = False) -> DataFrame:
    """A finding for each probe where ``col`` doesn't hold every one of ``names`` once, or anything else unless ``others``."""
    known = _sure(F.col(col).isin(*names))
    n = df.groupBy("probe_id").agg(*[F.count_if(F.col(col) == name).alias(f"n{i}") for i, name in enumerate(names)], F.count_if(~known).alias("rest"))
    once = reduce(Column.__and__, [F.coalesce(F.col(f"n{i}"), F.lit(0)) == 1 for i in range(len(names))])
    return _found(_meet(probes, n, "probe_id", "left"), "broken", {rule: ~once | (F.lit(False) if others else F.coalesce("rest", F.lit(0)) > 0)})


def _twice(df: DataFrame, col: str, rule: str) -> DataFrame:
    return _found(df.groupBy("probe_id", col).count(), "broken", {rule: F.col("count") > 1})


def _drive(col: str) -> Column:
    """A name's stem, drive (``P`` is a point), flavor and tail; null where it has no such form."""
    part = lambda g: F.regexp_extract(col, DRIVE, g)
    parts = F.struct(part(1).alias("stem"), F.replace(part(2), F.lit("P"), F.lit(".")).try_cast("double").alias("drive"), part(3).alias("flavor"), part(4).alias("tail"))
    return F.when(F.col(col).rlike(DRIVE), parts)


def _metadata(df: DataFrame) -> list[DataFrame]:
    kind, value = F.col("type"), F.col("value")
    typed = F.when(kind == "integer", _whole("value", -(2**63))).when(kind == "boolean", _flag("value")).otherwise(kind.isin("string", "path"))
    says = reduce(lambda so_far, item: so_far.when(F.col("key") == item[0], value == item[1]), SAYS.items(), F.when(F.col("key").isNull(), False))
    says = says.when(F.col("key") == "design_mutations", (kind == "integer") & (value.try_cast("long") == 0)).when(F.col("key") == "gold_eligible", (kind == "boolean") & F.lower("value").isin("false", "0")).otherwise(True)
    return [_found(df, "broken", {"metadata.key": ~_text("key"), "metadata.value": ~typed, "metadata.says": ~says}), _twice(df, "key", "metadata.twice")]


def _candidates(df: DataFrame) -> list[DataFrame]:
    group = Window.partitionBy("probe_id", "analysis", "hierarchy_group").orderBy("line")
    key = F.struct(F.col("slack_ns").try_cast("double").alias("slack"), *ORDER)
    placed = df.withColumns({"_place": F.row_number().over(group) - 1, "_key": key}).withColumn("_back", F.coalesce(F.col("_key") < F.lag("_key").over(group), F.lit(False)))
    rules = {
        "candidates.analysis": ~(F.col("analysis").isin(*ANALYSES) & F.col("hierarchy_group").isin(*GROUPS)), "candidates.stable_rank": ~_whole("stable_rank"), "candidates.slack_ns": ~_number("slack_ns"),
        "candidates.source_path_index": ~_whole("source_path_index"), **{f"candidates.{c}": ~_text(c) for c in ("view", *ORDER)},
        "candidates.rank_gap": F.col("stable_rank").try_cast("long") != F.col("_place"), "candidates.order": F.col("_back"),
    }
    return [_found(placed, "broken", rules)]


def _families(df: DataFrame, candidates: DataFrame) -> list[DataFrame]:
    f = df.withColumns({"_s": _drive("source_ref"), "_v": _drive("variant_ref"), "_has": _sure(_text("variant_ref"))})
    named, has = F.col("_s").isNotNull(), F.col("_has")
    same = (F.col("_s.stem") == F.col("_v.stem")) & (F.col("_s.flavor") == F.col("_v.flavor")) & (F.col("_s.tail") == F.col("_v.tail"))
    own = (F.col("stem") == F.col("_s.stem")) & (F.coalesce("flavor", F.lit("")) == F.col("_s.flavor")) & (F.col("tail") == F.col("_s.tail")) & (F.col("source_drive").try_cast("double") == F.col("_s.drive"))
    broken = {
        "families.unmarked": ~named & ~_sure(F.col("signature_status") == "UNSUPPORTED_PATTERN"), "families.parts": named & ~_sure(own), "families.active_copy_count": named & ~_sure(_whole("active_copy_count")),
        "families.variant_parts": named & has & ~_sure(same), "families.variant_drive": named & has & ~_sure(F.col("variant_drive").try_cast("double") == F.col("_v.drive")),
    }
    alike = _sure((F.col("signature_status") == "OK") & (F.col("equivalent_to_source") == "TRUE"))
    lacking = _meet(candidates.where(_text("driver_ref")).select("probe_id", F.col("driver_ref").alias("source_ref")).distinct(), df, ["probe_id", "source_ref"], "left_anti")
    return [_found(f, "broken", broken), _found(f, "unsupported", {"drive_family": ~named | ~has, "drive_signature": named & has & ~alike}), _found(lacking, "broken", {"families.missing_source": F.lit(True)})]


def _signatures(df: DataFrame) -> list[DataFrame]:
    full = _text("input_pins") & _text("output_functions") & _text("signature")
    rules = {"signatures.status": ~F.col("status").isin("OK", "UNSUPPORTED"), "signatures.names": ~(_text("reference") & _text("lib_cell")), "signatures.empty": _sure(F.col("status") == "OK") & ~_sure(full)}
    return [_found(df, "broken", rules), _found(df, "unsupported", {"lib_signature": F.col("status") == "UNSUPPORTED"}), _twice(df.where(_text("lib_cell")), "lib_cell", "signatures.twice")]


def written_constraints(sdc: DataFrame, files: DataFrame) -> DataFrame:
    """Both constraint files of each analysis compared: probe_id, analysis, in_order (sequences 1 and 2, once each), usable (both written), raw_equal, normalized_equal (comments with a time masked).

    A text that is missing or null is equal to nothing.
    """
    texts = files.select("probe_id", "relative_file", "text")
    at = lambda n: F.max(F.when(F.col("sequence") == n, F.col("text")))
    rows = _meet(sdc.where(F.col("analysis").isin(*WRITTEN)), texts, ["probe_id", "relative_file"], "left").groupBy("probe_id", "analysis").agg(
        ((F.count("*") == 2) & (F.count_if(F.col("sequence") == "1") == 1) & (F.count_if(F.col("sequence") == "2") == 1)).alias("in_order"), (F.count_if(F.col("status") == "OK") == F.count("*")).alias("usable"),
        at("1").alias("left"), at("2").alias("right"),
    )
    return normalize_timestamp_lines(rows).select("probe_id", "analysis", "in_order", "usable", _sure(F.col("raw_equal")).alias("raw_equal"), _sure(F.col("normalized_equal")).alias("normalized_equal"))


def _violation_report(reports: DataFrame, files: DataFrame) -> DataFrame:
    """A finding for each rule check report without its one command, with another limit than DRC_LIMIT or none, that says it was cut, or whose total isn't that of its records."""
    r = _meet(reports.where("report_command = 'verify_drc' and status = 'OK'").select("probe_id", "relative_file"), files.select("probe_id", "relative_file", "text"), ["probe_id", "relative_file"])
    commands = F.regexp_extract_all("text", F.lit(r"(?mi)^#\s*Command:\s*(\S.*)$"), F.lit(1))
    command = F.get(commands, F.lit(0))
    asked = (F.size(commands) == 1) & command.rlike(r"(?i)(^|\s)verify_drc(\s|$)") & (F.regexp_count(command, F.lit(r"(?i)(?:^|\s)-limit(?=\s|$)")) == 1) & command.rlike(rf"(?i)(^|\s)-limit\s+(\{{{DRC_LIMIT}\}}|{DRC_LIMIT})(\s|$)")
    body = F.filter(F.split("text", r"\r?\n"), lambda x: ~x.rlike(r"^\s*#") & ~x.rlike(r"(?i)\bnot\b.{0,24}\b(reach|exceed)\w*\b"))
    # fixed values: words that tell of a report cut short
    cut = F.exists(body, lambda x: x.rlike(r"(?i)\btruncat\w*\b|\b(limit|maximum)\b.{0,96}\b(reach|exceed|hit|stop|terminat)\w*\b|\b(reach|exceed|hit)\w*\b.{0,96}\b(limit|maximum)\b|\b(stop|terminat)\w*\b.{0,96}\b(error|violation)s?\b|\b(only|first)\s+\d+\s+(error|violation)s?\b.{0,96}\b(report|show|list)\w*\b"))
    total = F.size(F.regexp_extract_all("text", F.lit(r"(?mi)^\s*Total\s+Violations\s*:\s*(\d+)\s+Viols?\.\s*$"), F.lit(1))) == 1
    whole = parse_drc_categories(r.select("probe_id", "text"), DRC_LIMIT).groupBy("probe_id").agg(F.bool_and("complete").alias("complete"))
    return _found(r, "broken", {"drc.command": ~asked, "drc.cut": cut, "drc.total": ~total}).unionByName(_found(whole, "broken", {"drc.records": ~F.col("complete")}))


def probe_findings(tables: dict[str, DataFrame], files: DataFrame, status: DataFrame) -> DataFrame:
    """All that is wrong with, or not supported by, each probe: probe_id, kind (``broken`` or ``unsupported``), rule, n (rows that break it). A sound probe has no rows.

    ``tables``: the twelve of COLUMNS as text with probe_id, candidates with ``line`` too (place in the file); ``files``: probe_id, relative_file, bytes, text (null where nothing reads it), one row a file;
    ``status``: probe_id, text. A probe is known by its status, metadata or manifest; rows without a probe_id are left out. Null fields count as empty, and what can't be judged is broken. Tables of one
    probe are as small as a probe (20,000 paths at most), any number of probes is judged at once: rows become findings where they are and are counted before they are shuffled.
    """
    t = {name: tables[name].where("probe_id is not null") for name in COLUMNS}
    files, status = files.where("probe_id is not null"), status.where("probe_id is not null")
    manifest, commands, sdc, reports, picks, candidates = (t[n] for n in ("artifact_manifest.tsv", "command_probe.tsv", "sdc_write_probe.tsv", "report_probe.tsv", "selection_probe.tsv", "candidate_paths.tsv"))
    probes = status.select("probe_id").unionByName(manifest.select("probe_id")).unionByName(t["probe_metadata.tsv"].select("probe_id")).distinct()
    out = [*_metadata(t["probe_metadata.tsv"]), *_candidates(candidates), *_families(t["drive_families.tsv"], candidates), *_signatures(t["lib_signatures.tsv"]), _violation_report(reports, files)]
    out += [_exactly(probes, t["probe_metadata.tsv"], "key", METADATA, "metadata.missing", True), _exactly(probes, commands, "command", COMMANDS, "commands.names"), _exactly(probes, picks, "query", SELECTIONS, "selection.names"), _exactly(probes, reports, "report_command", REPORTS, "reports.names")]

    marked = reduce(Column.__and__, [F.contains("text", F.lit(m)) for m in MARKS])
    out.append(_found(_meet(probes, status.groupBy("probe_id").agg(F.bool_or(_sure(marked)).alias("marked")), "probe_id", "left"), "broken", {"status.marks": ~F.col("marked")}))

    supported = F.col("help_status") == "SUPPORTED"
    out.append(_found(commands, "broken", {"commands.exists": ~_flag("command_exists"), "commands.help_status": ~F.col("help_status").isin("SUPPORTED", "UNSUPPORTED"), "commands.missing_tokens": _sure(supported & _text("missing_tokens")), "commands.absent": _sure(supported) & ~_yes("command_exists")}))
    out.append(_found(commands, "unsupported", {"help": F.col("help_status") != "SUPPORTED"}))

    matched = picks.groupBy("probe_id").agg(F.bool_or((F.col("status") == "OK") & _yes("exact_match")).alias("matched"))
    out.append(_found(picks, "broken", {"selection.result_count": ~_whole("result_count"), "selection.exact_match": ~_flag("exact_match"), "selection.status": ~F.col("status").isin("OK", "UNSUPPORTED")}))
    out.append(_found(_meet(probes, matched, "probe_id", "left"), "unsupported", {"selection": ~_sure(F.col("matched"))}))

    out.append(_found(reports, "broken", {"reports.status": ~F.col("status").isin("OK", "UNSUPPORTED"), "reports.bytes": ~_whole("bytes")}))
    out.append(_found(reports, "unsupported", {"report": F.col("status") == "UNSUPPORTED"}))

    both = sdc.groupBy("probe_id", "analysis").agg((F.count_if(F.col("status") == "OK") == F.count("*")).alias("usable"))
    pairs = _meet(probes.select("probe_id", F.explode(F.array(*map(F.lit, WRITTEN))).alias("analysis")), written_constraints(sdc, files), ["probe_id", "analysis"], "left")
    out += [_found(pairs, "broken", {"sdc.sequence": ~F.col("in_order")}), _found(pairs, "unsupported", {"write_sdc": ~F.col("usable")})]
    used = _meet(sdc.where(F.col("analysis").isin(*WRITTEN)), both.where("usable").drop("usable"), ["probe_id", "analysis"], "left_semi")
    out.append(_found(used, "broken", {"sdc.bytes": ~_whole("bytes", 1)}))

    kept = tuple(n for n in COLUMNS if n != "artifact_manifest.tsv")
    counts = reduce(DataFrame.unionByName, [t[n].select("probe_id", F.lit(n).alias("relative_file")) for n in kept]).groupBy("probe_id", "relative_file").agg(F.count("*").alias("n"))
    declared = _meet(_meet(probes.select("probe_id", F.explode(F.array(*map(F.lit, kept))).alias("relative_file")), manifest.withColumn("listed", F.lit(True)), ["probe_id", "relative_file"], "left"), counts, ["probe_id", "relative_file"], "left")
    listed = _sure(F.col("listed"))
    out.append(_found(declared, "broken", {"manifest.missing": ~listed, "manifest.row_count": listed & ~_sure(_whole("row_count") & (F.col("row_count").try_cast("long") == F.coalesce("n", F.lit(0)))), "manifest.bytes": listed & ~_sure(_whole("bytes", 1))}))
    out.append(_twice(manifest, "relative_file", "manifest.twice"))

    claim = lambda df, rule, path, n: df.select("probe_id", F.lit(rule).alias("rule"), F.coalesce(path, F.lit("")).alias("relative_file"), n.try_cast("long").alias("claimed"))
    claims = claim(commands.where(supported), "commands.file", "raw_help_file", F.lit(None).cast("string")).unionByName(claim(used, "sdc.file", "relative_file", F.col("bytes")))
    claims = claims.unionByName(claim(reports.where("status = 'OK'"), "reports.file", "relative_file", F.col("bytes"))).unionByName(claim(manifest.where(F.col("relative_file").isin(*kept)), "manifest.file", "relative_file", F.col("bytes")))
    met = _meet(claims, files.select("probe_id", "relative_file", F.col("bytes").cast("long").alias("is")), ["probe_id", "relative_file"], "left")
    outside = F.col("relative_file").rlike(r"^/|(^|/)\.\.(/|$)")
    bad = outside | ~_sure((F.col("is") > 0) & (F.col("is") == F.coalesce("claimed", "is")))
    out.append(met.where(bad).select("probe_id", F.lit("broken").alias("kind"), "rule"))

    out.append(_found(t["unsupported_apis.tsv"], "unsupported", {"collector": F.lit(True)}))
    out.append(_found(_meet(probes, candidates, "probe_id", "left_anti"), "unsupported", {"no_candidates": F.lit(True)}))
    # some rules at a time: the plan of all at once is more than a small driver holds
    some = [written(reduce(DataFrame.unionByName, out[i : i + 8]).groupBy(*FINDING).agg(F.count("*").alias("n"))) for i in range(0, len(out), 8)]
    return reduce(DataFrame.unionByName, some).groupBy(*FINDING).agg(F.sum("n").alias("n"))


def probe_summary(tables: dict[str, DataFrame], files: DataFrame, status: DataFrame) -> DataFrame:
    """One row a probe with a status: probe_id, complete, n_broken and n_unsupported (rules), n_candidates, n_refs, n_sources, n_variants, n_rejections, n_equal_constraints (analyses whose two files differ at most in times).

    Same input and edge cases as ``probe_findings``.
    """
    found = probe_findings(tables, files, status).groupBy("probe_id").agg(F.count_if(F.col("kind") == "broken").alias("n_broken"), F.count_if(F.col("kind") == "unsupported").alias("n_unsupported"))
    named = F.col("source_ref").rlike(DRIVE) & _text("variant_ref")
    parts = [
        found, tables["candidate_paths.tsv"].groupBy("probe_id").agg(F.count("*").alias("n_candidates"), F.count_distinct("driver_ref").alias("n_refs")),
        tables["drive_families.tsv"].groupBy("probe_id").agg(F.count_distinct("source_ref").alias("n_sources"), F.count_if(named).alias("n_variants")), tables["path_rejections.tsv"].groupBy("probe_id").agg(F.count("*").alias("n_rejections")),
        written_constraints(tables["sdc_write_probe.tsv"], files).groupBy("probe_id").agg(F.count_if(F.col("usable") & F.col("normalized_equal")).alias("n_equal_constraints")),
    ]
    known = status.where("probe_id is not null").groupBy("probe_id").agg(F.bool_or(_sure(F.contains("text", F.lit(COMPLETE)))).alias("complete"))
    every = reduce(lambda a, b: _meet(a, b, "probe_id", "left"), map(written, parts), known)
    return every.select("probe_id", "complete", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in every.columns if c.startswith("n_")])


# --- registered queries ---


def _probes(t) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """A probe for each customer, its candidates made of the orders; some probes break one rule each, by their number."""
    c = t.customer.select(F.col("c_custkey").alias("probe_id"))
    odd = lambda k: F.col("probe_id") % k == 0

    def rows(name: str, *made: tuple) -> DataFrame:
        cells = F.array(*[F.struct(*[(v if isinstance(v, Column) else F.lit(v)).cast("string").alias(f) for f, v in zip(COLUMNS[name].split(), row)]) for row in made])
        return c.select("probe_id", F.explode(cells).alias("_r")).select("probe_id", "_r.*")

    sdc_text = lambda n, p: F.concat(F.lit(f"# Generated at 10:00:0{n}\ncreate_clock -period "), F.when(odd(p) & F.lit(n == 2), "9").otherwise("8"), F.lit(" clk\n"))
    drc = F.concat(F.lit("# Command: verify_drc -limit 1000000\nMETAL: (\n  Total Violations : "), F.when(odd(41), "2").otherwise("1"), F.lit(" Viols.\n"))
    o = t.orders.select(F.col("o_custkey").alias("probe_id"), F.col("o_orderkey").alias("k"), F.when(F.col("o_orderstatus") == "F", "early").otherwise("late").alias("analysis"), (F.col("o_totalprice") / 1e6).alias("slack"))
    place = Window.partitionBy("probe_id", "analysis").orderBy("slack", F.col("k").cast("string"))
    one, text = F.row_number().over(place), lambda p: F.concat(F.lit(p), F.col("k").cast("string"))
    ref = F.concat(F.lit("INV_X"), F.when(F.col("analysis") == "late", "2").otherwise("0P5"), F.lit("B_R"))
    candidates = written(o.select("probe_id", one.alias("line"), "analysis", F.lit("v").alias("view"), F.lit("exp").alias("hierarchy_group"), (one - 1 + F.when(odd(17), 1).otherwise(0)).cast("string").alias("stable_rank"), F.col("slack").cast("string").alias("slack_ns"), text("b").alias("beginpoint"),
        F.col("k").cast("string").alias("endpoint"), text("p").alias("driver_pin"), text("i").alias("driver_inst"), ref.alias("driver_ref"), text("n").alias("net"), F.col("k").cast("string").alias("source_path_index")))
    metadata = [(k, "integer" if k in ("process_id", "design_mutations") else "boolean" if k == "gold_eligible" else "string", SAYS.get(k, {"process_id": "7", "design_mutations": "0", "gold_eligible": "false"}.get(k, "x"))) for k in METADATA]
    tables = {
        "pre_restore_state.tsv": rows("pre_restore_state.tsv", ("design", "OK", "", "")), "probe_metadata.tsv": rows("probe_metadata.tsv", *metadata).where(~(odd(7) & (F.col("key") == "top"))),
        "command_probe.tsv": rows("command_probe.tsv", *[(k, "1", F.when(odd(11) & F.lit(k == "rcOut"), "UNSUPPORTED").otherwise("SUPPORTED"), "-v", "", f"help/{k}", "") for k in COMMANDS]),
        "sdc_write_probe.tsv": rows("sdc_write_probe.tsv", *[(a, "v", str(n), "OK", f"sdc/{a}{n}", "50", "") for a in WRITTEN for n in (1, 2)]), "candidate_paths.tsv": candidates,
        "path_rejections.tsv": o.where("slack > 0.2").select("probe_id", "analysis", F.col("k").cast("string").alias("source_path_index"), F.col("slack").cast("string").alias("slack_ns"), text("b").alias("beginpoint"), text("").alias("endpoint"), F.lit("far").alias("reason"), F.lit("").alias("detail")),
        "lib_signatures.tsv": rows("lib_signatures.tsv", ("INV_X2B_R", "l/a", "l", "A", "!A", F.when(odd(43), "").otherwise("s"), "OK", ""), ("INV_X4B_R", "l/b", "l", "A", "!A", "s", F.when(odd(31), "UNSUPPORTED").otherwise("OK"), "")),
        "drive_families.tsv": rows("drive_families.tsv", ("INV_X2B_R", "2", "INV", "B", "R", F.when(odd(19), "BUF_X4B_R").otherwise("INV_X4B_R"), "4", "1", "OK", "TRUE"), ("INV_X0P5B_R", "0.5", "INV", "B", "R", "INV_X1B_R", "1", "1", "OK", "TRUE")),
        "selection_probe.tsv": rows("selection_probe.tsv", *[(k, "OK", "1", "a", "a", F.when(odd(23), "0").otherwise("TRUE"), "") for k in SELECTIONS]),
        "report_probe.tsv": rows("report_probe.tsv", *[(k, "OK", f"report/{k}", F.when(odd(29) & F.lit(k == "report_constraint"), "99").otherwise("70"), "") for k in REPORTS]), "unsupported_apis.tsv": rows("unsupported_apis.tsv", ("get", "")).where(odd(47)),
    }
    counts = reduce(DataFrame.unionByName, [d.select("probe_id", F.lit(n).alias("relative_file")) for n, d in tables.items()]).groupBy("probe_id", "relative_file").agg(F.count("*").alias("n"))
    listed = _meet(c.select("probe_id", F.explode(F.array(*map(F.lit, tables))).alias("relative_file")), counts, ["probe_id", "relative_file"], "left")
    off = F.when(odd(13) & (F.col("relative_file") == "selection_probe.tsv"), 1).otherwise(0)
    tables["artifact_manifest.tsv"] = written(listed.select("probe_id", "relative_file", F.lit("tsv").alias("schema"), (F.coalesce("n", F.lit(0)) + off).cast("string").alias("row_count"), F.lit("10").alias("bytes")))
    sizes = [*[(f"help/{k}", 5, None) for k in COMMANDS], *[(f"sdc/{a}{n}", 50, sdc_text(n, 5 if a == "hold" else 3)) for a in WRITTEN for n in (1, 2)], *[(f"report/{k}", 70, drc if k == "verify_drc" else None) for k in REPORTS], *[(n, 10, None) for n in tables]]
    cells = F.array(*[F.struct(F.lit(p).alias("relative_file"), F.lit(b).cast("long").alias("bytes"), (F.lit(x) if x is None else x).cast("string").alias("text")) for p, b, x in sizes])
    files = c.select("probe_id", F.explode(cells).alias("_f")).select("probe_id", "_f.*")
    status = c.select("probe_id", F.concat(F.lit("GOLD_ELIGIBLE=FALSE\n"), F.when(odd(37), "").otherwise("DESIGN_MUTATIONS=0\n"), F.when(odd(2), COMPLETE).otherwise("")).alias("text"))
    return tables, files, status


_RULES = (
    (7, "broken", "metadata.missing", "1"), (11, "unsupported", "help", "1"), (13, "broken", "manifest.row_count", "1"), (19, "broken", "families.variant_parts", "1"), (23, "unsupported", "selection", "1"), (29, "broken", "reports.file", "1"), (31, "unsupported", "lib_signature", "1"),
    (37, "broken", "status.marks", "1"), (41, "broken", "drc.records", "1"), (43, "broken", "signatures.empty", "1"), (47, "unsupported", "collector", "1"),
)
_FINDINGS = " UNION ALL ".join(f"SELECT c_custkey AS probe_id, '{kind}' AS kind, '{rule}' AS rule, {n} AS n FROM customer WHERE c_custkey % {k} = 0" for k, kind, rule, n in _RULES) + """
    UNION ALL SELECT o_custkey, 'broken', 'candidates.rank_gap', count(*) FROM orders WHERE o_custkey % 17 = 0 GROUP BY o_custkey
    UNION ALL SELECT c_custkey, 'unsupported', 'no_candidates', 1 FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)"""
query("probe_findings", _FINDINGS)(lambda t: probe_findings(*_probes(t)))
query("probe_summary", f"""WITH f AS ({_FINDINGS}), g AS (SELECT probe_id, count(CASE WHEN kind = 'broken' THEN 1 END) AS b, count(CASE WHEN kind = 'unsupported' THEN 1 END) AS u FROM f GROUP BY probe_id),
    o AS (SELECT o_custkey, count(*) AS n, count(DISTINCT o_orderstatus = 'F') AS r, count(CASE WHEN o_totalprice / 1e6 > 0.2 THEN 1 END) AS far FROM orders GROUP BY o_custkey)
    SELECT c_custkey AS probe_id, c_custkey % 2 = 0 AS complete, coalesce(b, 0) AS n_broken, coalesce(u, 0) AS n_unsupported, coalesce(n, 0) AS n_candidates, coalesce(r, 0) AS n_refs, CAST(2 AS BIGINT) AS n_sources, CAST(2 AS BIGINT) AS n_variants,
    coalesce(far, 0) AS n_rejections, CAST(CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE 1 END + CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE 1 END AS BIGINT) AS n_equal_constraints FROM customer LEFT JOIN g ON g.probe_id = c_custkey LEFT JOIN o ON o_custkey = c_custkey""")(
    lambda t: probe_summary(*_probes(t))
)
