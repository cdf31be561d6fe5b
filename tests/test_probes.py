"""One sound probe, copied for every rule with one thing changed; all are judged at once."""

from millrace.functions.text import render_evidence
from millrace.operators.probes import COLUMNS, COMMANDS, METADATA, REPORTS, SAYS, SELECTIONS, WRITTEN, probe_findings, probe_summary
from millrace.operators.timing import drive_variants

DRC = "# Command: verify_drc -limit {1000000}\nVIA1: (\n  Total Violations : 1 Viols.\n# done\n"


def sound():
    """Rows by table, texts and bytes of files, and the status of a probe without faults."""
    typed = {"process_id": ("integer", "7"), "design_mutations": ("integer", "0"), "gold_eligible": ("boolean", "FALSE")}
    tables = {
        "pre_restore_state.tsv": [["top", "OK", "", ""]], "probe_metadata.tsv": [[k, *typed.get(k, ("string", SAYS.get(k, "x")))] for k in METADATA],
        "command_probe.tsv": [[k, "1", "SUPPORTED", "-v", "", f"help/{k}", ""] for k in COMMANDS], "sdc_write_probe.tsv": [[a, "v", str(n), "OK", f"sdc/{a}.{n}", "30", ""] for a in WRITTEN for n in (1, 2)],
        "candidate_paths.tsv": [["late", "v", "exp", str(i), f"0.0{i + 1}", "q/Q", f"d{i}/D", "p/Z", "p", "OR2_X1P5L_G", "w", "3"] for i in range(3)] + [["early", "v", "exp", "0", "-1e-3", "q/Q", "d/D", "p/Z", "p", "OR2_X1P5L_G", "w", "4"]],
        "path_rejections.tsv": [["late", "9", "0.5", "a", "b", "slow", ""]], "lib_signatures.tsv": [["OR2_X1P5L_G", "lib/or", "lib", "A B", "A+B", "sig", "OK", ""]],
        "drive_families.tsv": [["OR2_X1P5L_G", "1.5", "OR2", "L", "G", "OR2_X4L_G", "4", "1", "OK", "TRUE"]], "selection_probe.tsv": [[k, "OK", "1", "a", "a", "true", ""] for k in SELECTIONS],
        "report_probe.tsv": [[k, "OK", f"rpt/{k}", "80", ""] for k in REPORTS], "unsupported_apis.tsv": [],
    }
    tables["artifact_manifest.tsv"] = [[n, "tsv", str(len(rows)), "10"] for n, rows in tables.items()]
    files = {**{f"help/{k}": [3, None] for k in COMMANDS}, **{f"sdc/{a}.{n}": [30, f"# at 10:00:0{n}\nclock\n"] for a in WRITTEN for n in (1, 2)}, **{f"rpt/{k}": [80, DRC if k == "verify_drc" else None] for k in REPORTS}, **{n: [10, None] for n in COLUMNS}}
    return tables, files, ["GOLD_ELIGIBLE=FALSE DESIGN_MUTATIONS=0 SFT_INNOVUS_READONLY_PROBE_COMPLETE"]


def cell(table, row, field, value):
    def change(tables, files, status):
        tables[table][row][COLUMNS[table].split().index(field)] = value

    return change


def call(f):
    return lambda tables, files, status: f(tables, files, status)


M, C, F_, S, P = "probe_metadata.tsv", "candidate_paths.tsv", "drive_families.tsv", "lib_signatures.tsv", "selection_probe.tsv"
REPORT, SDC, LIST, HELP = "report_probe.tsv", "sdc_write_probe.tsv", "artifact_manifest.tsv", "command_probe.tsv"
drc = lambda text: call(lambda t, f, s: f["rpt/verify_drc"].__setitem__(1, text))
CASES = [
    (call(lambda t, f, s: None), set()),
    (cell(M, 2, "value", "7.5"), {"metadata.value"}), (cell(M, 2, "type", "float"), {"metadata.value"}), (cell(M, 0, "value", "other"), {"metadata.says"}), (cell(M, 0, "value", None), {"metadata.says"}), (cell(M, 9, "value", "1"), {"metadata.says"}),
    (cell(M, 10, "value", "true"), {"metadata.says"}), (cell(M, 5, "key", "top2"), {"metadata.missing"}), (cell(M, 5, "key", None), {"metadata.key", "metadata.says", "metadata.missing"}),
    (call(lambda t, f, s: (t[M].append(["more", "path", "/x"]), t[M].append(["more", "path", "/y"]), t[LIST][1].__setitem__(2, "13"))), {"metadata.twice"}),
    (cell(HELP, 0, "command", "other"), {"commands.names"}), (cell(HELP, 1, "command_exists", "yes"), {"commands.exists", "commands.absent"}), (cell(HELP, 1, "command_exists", "0"), {"commands.absent"}), (cell(HELP, 1, "missing_tokens", "-v"), {"commands.missing_tokens"}),
    (cell(HELP, 1, "help_status", "UNSUPPORTED"), {"help"}), (cell(HELP, 1, "help_status", "?"), {"commands.help_status", "help"}), (cell(HELP, 1, "raw_help_file", "../x"), {"commands.file"}), (call(lambda t, f, s: f["help/rcOut"].__setitem__(0, 0)), {"commands.file"}),
    (cell(SDC, 1, "sequence", "3"), {"sdc.sequence"}), (cell(SDC, 1, "status", "NO"), {"write_sdc"}), (cell(SDC, 1, "bytes", "31"), {"sdc.file"}), (cell(SDC, 1, "bytes", "0"), {"sdc.bytes", "sdc.file"}), (call(lambda t, f, s: f.pop("sdc/hold.2")), {"sdc.file"}),
    (cell(C, 1, "stable_rank", "2"), {"candidates.rank_gap"}), (cell(C, 1, "stable_rank", "x"), {"candidates.stable_rank", "candidates.rank_gap"}), (cell(C, 1, "slack_ns", "0.5"), {"candidates.order"}), (cell(C, 2, "slack_ns", "inf"), {"candidates.slack_ns"}),
    (cell(C, 0, "net", ""), {"candidates.net"}), (cell(C, 0, "source_path_index", "-1"), {"candidates.source_path_index"}), (cell(C, 3, "analysis", "typical"), {"candidates.analysis"}), (cell(C, 0, "driver_ref", "AND_X1_G"), {"families.missing_source"}),
    (call(lambda t, f, s: (t[C].clear(), t[LIST][4].__setitem__(2, "0"))), {"no_candidates"}),
    (cell(S, 0, "status", "?"), {"signatures.status"}), (cell(S, 0, "status", "UNSUPPORTED"), {"lib_signature"}), (cell(S, 0, "signature", None), {"signatures.empty"}), (cell(S, 0, "lib_cell", ""), {"signatures.names"}),
    (call(lambda t, f, s: (t[S].append(t[S][0]), t[LIST][6].__setitem__(2, "2"))), {"signatures.twice"}),
    (cell(F_, 0, "source_drive", "2"), {"families.parts"}), (cell(F_, 0, "variant_ref", "OR2_X4H_G"), {"families.variant_parts"}), (cell(F_, 0, "variant_drive", "5"), {"families.variant_drive"}), (cell(F_, 0, "active_copy_count", "-1"), {"families.active_copy_count"}),
    (cell(F_, 0, "variant_ref", ""), {"drive_family"}), (cell(F_, 0, "equivalent_to_source", "FALSE"), {"drive_signature"}), (cell(F_, 0, "source_ref", "odd"), {"families.unmarked", "drive_family", "families.missing_source"}),
    (cell(P, 0, "exact_match", "maybe"), {"selection.exact_match"}), (cell(P, 0, "query", "x"), {"selection.names"}), (cell(P, 0, "status", "x"), {"selection.status"}), (cell(P, 0, "result_count", "-2"), {"selection.result_count"}),
    (call(lambda t, f, s: [r.__setitem__(5, "0") for r in t[P]]), {"selection"}),
    (cell(REPORT, 0, "status", "UNSUPPORTED"), {"report"}), (cell(REPORT, 0, "status", None), {"reports.status"}), (cell(REPORT, 0, "bytes", "81"), {"reports.file"}), (cell(REPORT, 0, "bytes", "many"), {"reports.bytes"}), (cell(REPORT, 0, "report_command", "x"), {"reports.names"}),
    (drc(DRC.replace("{1000000}", "1000")), {"drc.command"}), (drc(DRC + "# Command: again\n"), {"drc.command"}), (drc(DRC + "Limit of errors reached\n"), {"drc.cut"}), (drc(DRC + "limit was not reached\n"), set()), (drc(DRC.replace(" 1 V", " 2 V")), {"drc.records"}),
    (drc(DRC.replace("Total", "All")), {"drc.total", "drc.records"}), (drc(None), {"drc.command", "drc.cut", "drc.total", "drc.records"}),
    (cell(LIST, 3, "row_count", "5"), {"manifest.row_count"}), (cell(LIST, 3, "bytes", "11"), {"manifest.file"}), (cell(LIST, 3, "bytes", "0"), {"manifest.bytes", "manifest.file"}), (call(lambda t, f, s: t[LIST].pop(3)), {"manifest.missing"}), (call(lambda t, f, s: t[LIST].append(t[LIST][3])), {"manifest.twice"}),
    (call(lambda t, f, s: s.__setitem__(0, "GOLD_ELIGIBLE=FALSE")), {"status.marks"}), (call(lambda t, f, s: s.clear()), {"status.marks"}), (call(lambda t, f, s: (t["unsupported_apis.tsv"].append(["x", ""]), t[LIST][10].__setitem__(2, "1"))), {"collector"}),
]


def frames(spark, probes):
    tables = {}
    for name, fields in COLUMNS.items():
        rows = [(i, n, *row) for i, (t, _, _) in enumerate(probes) for n, row in enumerate(t[name])]
        rows += [(None, 0, *probes[0][0][name][0])] if probes and probes[0][0][name] else []
        tables[name] = spark.createDataFrame(rows, f"probe_id long, line int, {', '.join(f'`{f}` string' for f in fields.split())}")
    files = spark.createDataFrame([(i, p, b, x) for i, (_, f, _) in enumerate(probes) for p, (b, x) in f.items()], "probe_id long, relative_file string, bytes long, text string")
    return tables, files, spark.createDataFrame([(i, s) for i, (_, _, status) in enumerate(probes) for s in status], "probe_id long, text string")


def test_every_rule_by_one_mutation(spark):
    probes = []
    for change, _ in CASES:
        probe = sound()
        change(*probe)
        probes.append(probe)
    got = {i: set() for i in range(len(CASES))}
    for r in probe_findings(*frames(spark, probes)).collect():
        got[r["probe_id"]].add(r["rule"])
    assert {i: rules for i, rules in got.items() if rules != CASES[i][1]} == {}


def test_summary_of_a_sound_probe_and_of_none(spark):
    (row,) = probe_summary(*frames(spark, [sound()])).collect()
    assert row.asDict() == {"probe_id": 0, "complete": True, "n_broken": 0, "n_unsupported": 0, "n_candidates": 4, "n_refs": 1, "n_sources": 1, "n_variants": 1, "n_rejections": 1, "n_equal_constraints": 2}
    assert probe_summary(*frames(spark, [])).count() == 0


def test_variants_of_drives(spark):
    rows = [("A_X1_T", True, "f"), ("A_X1_T", True, "f"), ("A_X2_T", True, "f"), ("A_X2_T", False, "g"), ("A_X4_T", True, "f"), ("A_X4_T", True, "g"), ("A_X2L_T", True, "f"), ("plain", True, "f"), (None, True, "f"), ("B_X1_T", True, None), ("B_X0P5_T", True, None)]
    got = {(r["source_ref"], r["variant_ref"]): r["equivalent"] for r in drive_variants(spark.createDataFrame(rows, "ref string, active boolean, signature string")).collect()}
    family = ("A_X1_T", "A_X2_T", "A_X4_T")
    want = {(a, b): "A_X4_T" not in (a, b) for a in family for b in family if a != b} | {("A_X2L_T", None): None, ("plain", None): None, ("B_X1_T", "B_X0P5_T"): False, ("B_X0P5_T", "B_X1_T"): False}
    assert got == want
    assert drive_variants(spark.createDataFrame([], "ref string, active boolean, signature string")).count() == 0


def test_prompts_with_evidence(spark):
    heads = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], "case_id long, header string")
    targets = spark.createDataFrame([(1, 2, "b", -0.5), (1, 1, "a", -0.25), (2, 1, "a", None)], "case_id long, seq int, endpoint string, slack_ns double")
    cells = spark.createDataFrame([(1, "a", "u1", "Z", "INV", 0.1), (1, "a", "u2", "Z", "INV", 0.3), (1, "a", "u0", "Z", "INV", 0.1), (1, "b", "u9", "Y", "OR", 2.0), (1, "zz", "u8", "Y", "OR", 2.0), (2, "a", "u1", None, "INV", 0.1)], "case_id long, endpoint string, instance string, pin string, ref string, delay_ns double")
    got = {r["case_id"]: (r["prompt"], r["reasons"]) for r in render_evidence(heads, targets, cells).collect()}
    assert got[1] == ("one\n- a slack -0.250000 ns\n  1. u2 pin Z ref INV delay 0.300000 ns\n  2. u0 pin Z ref INV delay 0.100000 ns\n  3. u1 pin Z ref INV delay 0.100000 ns\n- b slack -0.500000 ns\n  1. u9 pin Y ref OR delay 2.000000 ns", [])
    assert got[2][1] == ["malformed_cell"] and got[3] == ("three", ["no_targets"])
    assert {r["case_id"]: r["reasons"] for r in render_evidence(heads, targets, cells, 2).collect()}[1] == ["few_cells"]
