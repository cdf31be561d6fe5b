"""Reports, scripts, cards and logs to rows, by built-in text functions; policies on texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.registry import query

#: The largest provable rule count, prefixes of sequential cells, commands that change constraints,
#: the lines beside resizes that a fix script holds, and the names that it may use.
DRC_LIMIT = 1_000_000
SEQUENTIAL = ("DFF", "SDFF", "LATCH", "LAT", "TLAT", "ICG", "CKG")
CONSTRAINT_COMMANDS = (
    "set_false_path", "set_multicycle_path", "set_disable_timing", "set_clock_uncertainty", "set_clock_latency", "set_max_delay", "set_min_delay",
    "reset_path", "set_input_delay", "set_output_delay", "create_clock", "set_analysis_view", "set_interactive_constraint_modes",
)
OPEN_BATCH, CLOSE_BATCH, LEGALIZE = "setEcoMode -batchMode true", "setEcoMode -batchMode false", "refinePlace -eco true"
SAFE_NAME = r"^[A-Za-z0-9_./\[\]$:+-]+$"
NUMBER = r"[-+]?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?"


def lines(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per line with its number from 0; CRLF counts as one line end."""
    # an outer explode: for an inner one Spark asks first whether there are elements, by making them again, twice
    return df.select("*", F.posexplode_outer(F.split(F.regexp_replace(text, "\r\n?", "\n"), "\n")).alias("line_no", "line")).where("line is not null")


def _path_blocks(reports: DataFrame) -> DataFrame:
    """One row ``b`` per ``Path N:`` block; other columns are kept."""
    blocks = F.slice(F.split(F.regexp_replace("text", "\r\n?", "\n"), r"(?m)^\s*Path (?=\d+:)", -1), 2, 2_000_000_000)
    return reports.select(*[c for c in reports.columns if c != "text"], F.explode_outer(blocks).alias("b")).where("b is not null")


def _block_field(name: str) -> Column:
    return F.nullif(F.regexp_extract("b", rf"(?m)^\s*{name}:\s*(\S+)", 1), F.lit(""))


def parse_timing_paths(reports: DataFrame, check: str | None = None, view: str | None = None) -> DataFrame:
    """Blocks of ``Path N:`` with check, endpoint, beginpoint, view, slack and reasons why a block proves nothing.

    The ``=`` before the slack is optional (hold reports leave it out). ``check`` (Setup or Hold) and ``view`` say what the report
    should be of. A null or empty text has no blocks.
    """
    slacks = F.regexp_extract_all("b", F.lit(rf"(?m)^\s*=?\s*Slack Time\s+({NUMBER})"), F.lit(1))
    head = lambda p: F.nullif(F.regexp_extract("b", p, 1), F.lit(""))
    out = _path_blocks(reports).withColumns({
        "path_no": F.regexp_extract("b", r"^(\d+):", 1).cast("long"), "endpoint": _block_field("Endpoint"), "beginpoint": _block_field("Beginpoint"), "view": _block_field("(?:Analysis )?View"),
        "_s": slacks, "status": F.regexp_extract("b", r"^\d+:\s*(MET|VIOLATED)", 1), "check": head(r"^\d+:\s*(?:MET|VIOLATED)\s+(\w+)\s+Check"),
    })
    out = out.withColumn("slack_ns", F.try_element_at("_s", F.lit(1)).cast("double"))
    other = lambda c, want: F.when(F.coalesce(F.col(c) != want, F.lit(True)), f"wrong_{c}") if want else F.lit(None).cast("string")
    reasons = F.array_compact(F.array(
        F.when(F.size("_s") != 1, "slack_count"), F.when(F.col("endpoint").isNull() | F.col("beginpoint").isNull() | F.col("view").isNull(), "missing_field"),
        F.when((F.col("status") == "VIOLATED") != (F.col("slack_ns") < 0), "status_sign"), other("check", check), other("view", view),
    ))
    return out.withColumn("reasons", reasons).drop("b", "_s")


def parse_path_points(reports: DataFrame, sequential: tuple[str, ...] = SEQUENTIAL, max_cells: int = 32) -> DataFrame:
    """Cells of the 7-column pipe table of each path block, from the row after the block's beginpoint on.

    A cell has a positive delay, a pin with ``/`` and a ref that is not sequential. Of several rows of one instance the slowest
    stays; of a path's cells the ``max_cells`` slowest stay (the longer delay first, then by instance). Returns the
    report's columns, endpoint, pin, edge, net, ref, delay_ns, instance and line_no, the row's place in the block.
    """
    keys = [c for c in reports.columns if c != "text"]
    # rows of other widths have another number of pipes and are not taken apart; one pass finds the beginpoint's row
    bare = lambda x: F.regexp_replace(F.trim(x), r"^\||\|$", "")
    lines_ = F.transform(F.split("b", "\n"), lambda x, i: F.struct(i.alias("line_no"), bare(x).alias("x")))
    table = F.filter(lines_, lambda r: F.length(r["x"]) - F.length(F.replace(r["x"], F.lit("|"), F.lit(""))) == 6)
    blocks = _path_blocks(reports).withColumns({"endpoint": _block_field("Endpoint"), "beginpoint": _block_field("Beginpoint"), "table": table})
    begin = F.array_position(F.transform("table", lambda r: F.trim(F.substring_index(r["x"], "|", 1))), F.col("beginpoint"))
    blocks = blocks.withColumn("begin", begin.cast("int"))
    cut = lambda r: F.struct(r["line_no"].alias("line_no"), F.transform(F.split(r["x"], r"\|"), lambda y: F.trim(y)).alias("c"))
    cells = blocks.withColumn("r", F.explode_outer(F.when(F.col("begin") > 0, F.transform(F.slice("table", F.col("begin") + 1, F.size("table")), cut))))
    at = lambda i: F.col("r.c")[i]
    # asked of what was cut, so that nothing is cut or replaced again for a test; the arrow of a pin has no slash
    cells = cells.where((at(4).try_cast("double") > 0) & (at(3) != "") & F.contains(at(0), F.lit("/")) & ~at(3).rlike("^(" + "|".join(sequential) + ")"))
    cells = cells.select(*keys, "endpoint", F.col("r.line_no").cast("long").alias("line_no"), F.regexp_replace(at(0), r"\s*->$", "").alias("pin"), at(1).alias("edge"), at(2).alias("net"), at(3).alias("ref"), at(4).try_cast("double").alias("delay_ns"))
    cells = cells.withColumn("instance", F.regexp_extract("pin", r"^(.*)/[^/]*$", 1))
    # a path's cells are few: ranks within (report, endpoint)
    one = cells.withColumn("_n", F.row_number().over(Window.partitionBy(*keys, "endpoint", "instance").orderBy(F.desc("delay_ns"), "line_no"))).where("_n = 1")
    return one.withColumn("_n", F.row_number().over(Window.partitionBy(*keys, "endpoint").orderBy(F.desc("delay_ns"), "instance"))).where(F.col("_n") <= max_cells).drop("_n")


def parse_drv_counts(reports: DataFrame) -> DataFrame:
    """Violators per ``Check type`` section: 5-column pipe rows of negative slack are counted, an explicit none is 0.

    Anything else, and a section with a row whose slack is not negative, proves nothing (null).
    """
    sections = F.slice(F.split("text", r"(?mi)^\s*Check\s+type\s*:\s*", -1), 2, 2_000_000_000)
    s = reports.select(*[c for c in reports.columns if c != "text"], F.explode(sections).alias("s"))
    slack = F.regexp_extract_all("s", F.lit(rf"(?m)^\s*\|[^|\n]*[^|\s][^|\n]*\|\s*{NUMBER}\s*\|\s*{NUMBER}\s*\|\s*({NUMBER})\s*\|[^|\n]*[^|\s][^|\n]*\|\s*$"), F.lit(1))
    n = F.size(slack)
    negative = F.forall(slack, lambda x: x.cast("double") < 0)
    count = F.when((n > 0) & negative, n).when((n == 0) & F.col("s").rlike(r"(?i)\bNo\s+(paths?|violations?)\b"), 0)
    return s.select(*[c for c in s.columns if c != "s"], F.lower(F.regexp_extract("s", r"^(\S+)", 1)).alias("check"), count.cast("long").alias("n"))


def parse_connectivity(reports: DataFrame) -> DataFrame:
    """Problem count: none said = 0; problems plus warnings; or typed counts if they add up to the printed total."""
    pick = lambda p, g=1: F.nullif(F.regexp_extract("text", p, g), F.lit("")).cast("long")
    typed = F.regexp_extract_all("text", F.lit(r"(\d+) Problem\(s\) \(IMPVFC-\d+\)"), F.lit(1))
    total = F.aggregate(typed, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))
    said = pick(r"(\d+) total info\(s\) created")
    n = F.when(F.lower("text").contains("no problems"), 0).when(pick(r"Found (\d+) problems? and (\d+) warnings?").isNotNull(), pick(r"Found (\d+) problems? and (\d+) warnings?") + pick(r"Found (\d+) problems? and (\d+) warnings?", 2)).when((F.size(typed) > 0) & (total == said), total)
    return reports.select(*[c for c in reports.columns if c != "text"], n.alias("n"))


def parse_drc_categories(reports: DataFrame, limit: int = DRC_LIMIT) -> DataFrame:
    """Records ``CATEGORY: (`` counted by category, and whether the report is complete.

    Complete: it says that no violations were found and lists none, or it has one total (``Total Violations : N Viols.``) below ``limit`` and
    lists that many records. A report without records gives one row with a null category.
    """
    keys = [c for c in reports.columns if c != "text"]
    names = F.regexp_extract_all("text", F.lit(r"(?m)^\s*([A-Z][A-Z0-9_.-]*):\s+\("), F.lit(1))
    totals = F.regexp_extract_all("text", F.lit(r"(?mi)^\s*Total\s+Violations\s*:\s*(\d+)\s+Viols?\.\s*$"), F.lit(1))
    total = F.when(F.size(totals) == 1, totals[0].cast("long")).when((F.size(totals) == 0) & F.col("text").rlike(r"(?i)No\s+DRC\s+violations\s+were\s+found"), 0)
    r = reports.select(*keys, names.alias("names"), F.coalesce((total < limit) & (F.size(names) == total), F.lit(False)).alias("complete"))
    found = r.select(*keys, "complete", F.explode_outer("names").alias("category"))
    return found.groupBy(*keys, "complete", "category").agg(F.count("category").alias("n"))


def parse_kv_marker(df: DataFrame, prefix: str, numbers: list[str], texts: list[str]) -> DataFrame:
    """``PREFIX k=v k=v`` lines to typed fields; reasons name what is missing or no number."""
    m = lines(df).where(F.startswith("line", F.lit(prefix + " ")))
    kv = F.str_to_map(F.substring("line", len(prefix) + 2, 1_000_000), F.lit(" "), F.lit("="))
    m = m.withColumn("kv", kv)
    got = {**{k: F.expr(f"try_cast(kv['{k}'] as double)") for k in numbers}, **{k: F.col("kv")[k] for k in texts}}
    reasons = F.array_compact(F.array(*[F.when(v.isNull(), F.lit(k)) for k, v in got.items()]))
    return m.withColumns({**got, "reasons": reasons}).drop("kv", "line", "line_no", "text")


def parse_fix_operations(scripts: DataFrame) -> DataFrame:
    """Scripts to their lines in order: command, instance and cell of a resize; ``refused`` lines are neither resizes with
    safe names nor one of the three fixed lines. Comments and blank lines are skipped."""
    l = lines(scripts).withColumn("line", F.trim("line")).where(~F.col("line").rlike("^(#|$)"))  # noqa: E741
    part = lambda g: F.nullif(F.regexp_extract("line", r"^ecoChangeCell\s+-inst\s+\{([^{}]+)\}\s+-cell\s+\{([^{}]+)\}$", g), F.lit(""))
    l = l.withColumns({"instance": part(1), "cell": part(2), "command": F.regexp_extract("line", r"^(\S+)", 1)})  # noqa: E741
    safe = F.coalesce(F.col("instance").rlike(SAFE_NAME) & F.col("cell").rlike(SAFE_NAME), F.lit(False))
    return l.select(*[c for c in scripts.columns if c != "text"], "line_no", "line", "command", "instance", "cell", (~safe & ~F.col("line").isin(OPEN_BATCH, CLOSE_BATCH, LEGALIZE)).alias("refused"))


def fix_script_reasons(scripts: DataFrame, expected: DataFrame) -> DataFrame:
    """Reasons why each script is no fix: refused lines, not one batch opened, closed and legalized, a last line that is not the
    legalization, another number of resizes than ``expected`` (script_id, n), an instance resized twice. No text, no lines."""
    n = lambda test: F.count_if(test)
    resize = F.col("instance").isNotNull() & ~F.col("refused")
    s = parse_fix_operations(scripts).groupBy("script_id").agg(
        n(F.col("refused")).alias("refused"), n(F.col("line") == OPEN_BATCH).alias("opens"), n(F.col("line") == CLOSE_BATCH).alias("closes"), n(F.col("line") == LEGALIZE).alias("legal"),
        F.max_by("line", "line_no").alias("last"), n(resize).alias("resizes"), F.count_distinct(F.when(resize, F.col("instance"))).alias("instances"),
    )
    s = scripts.select("script_id").distinct().join(s, "script_id", "left").join(expected, "script_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    reasons = F.array_compact(F.array(
        F.when(F.col("refused") > 0, "refused_line"), F.when(zero("opens") != 1, "open_batch"), F.when(zero("closes") != 1, "close_batch"), F.when(zero("legal") != 1, "legalize"),
        F.when(F.coalesce(F.col("last") != LEGALIZE, F.lit(True)), "last_line"), F.when(F.coalesce(zero("resizes") != F.col("n"), F.lit(True)), "resize_count"), F.when(F.col("instances") < F.col("resizes"), "resized_twice"),
    ))
    return s.select("script_id", zero("resizes").alias("resizes"), reasons.alias("reasons"))


def parse_catalog_cards(cards: DataFrame) -> DataFrame:
    """Markdown cards to shape, count, severity and its tolerance; ``consistent`` checks percent * 80 = ps."""
    pick = lambda p: F.regexp_extract("text", p, 1)
    ps = F.array_max(F.transform(F.regexp_extract_all("text", F.lit(r"(\d+)\s*ps"), F.lit(1)), lambda x: x.cast("long")))
    percent = F.nullif(pick(r"(\d+)%"), F.lit("")).cast("long")
    return cards.select(*[c for c in cards.columns if c != "text"], pick(r"(?m)^- shape: (\S+)").alias("shape"), F.nullif(pick(r"(?m)^- targets: (\d+)"), F.lit("")).cast("long").alias("target_count"), ps.alias("severity_ps"), F.greatest(F.lit(10.0), ps * 0.15).alias("tolerance_ps"), F.coalesce(percent * 80 == ps, F.lit(False)).alias("consistent"))


def extract_code_fence(answers: DataFrame, lang: str = "tcl") -> DataFrame:
    """The one fenced block of an answer and the diagnosis before it, with reasons where the form is broken."""
    fences = F.regexp_extract_all("text", F.lit(r"(?s)```(\w*)\n(.*?)```"), F.lit(2))
    langs = F.regexp_extract_all("text", F.lit(r"(?s)```(\w*)\n(.*?)```"), F.lit(1))
    diagnosis = F.trim(F.substring_index("text", "```", 1))
    sentences = F.regexp_count("diagnosis", F.lit(r"[.!?。]"))
    out = answers.withColumns({"code": F.try_element_at(fences, F.lit(1)), "diagnosis": diagnosis, "_n": F.size(fences), "_l": F.try_element_at(langs, F.lit(1))})
    reasons = F.array_compact(F.array(
        F.when(F.col("_n") != 1, "fence_count"), F.when(~F.coalesce(F.col("_l") == lang, F.lit(False)), "language"), F.when(~F.col("text").rlike(r"(?s)```\s*$"), "trailing_text"),
        F.when(F.length("diagnosis") < 12, "short_diagnosis"), F.when(~sentences.between(2, 4), "sentences"),
    ))
    return out.withColumn("reasons", reasons).drop("_n", "_l")


def parse_drive_name(df: DataFrame, col: str) -> DataFrame:
    """``stem_X<drive>[flavor]_tail`` to its parts; ``P`` in the drive is a point."""
    p = r"^(.*)_X(\d+(?:P\d+)?)([A-Z]*)(?:_(.*))?$"
    part = lambda g: F.regexp_extract(col, p, g)
    return df.withColumns({"stem": part(1), "drive": F.replace(part(2), F.lit("P"), F.lit(".")).try_cast("double"), "flavor": part(3), "tail": part(4)})


def parse_trace_commands(df: DataFrame) -> DataFrame:
    """Trace lines to op, address, data, mask, compare and polls; the register's name comes from the comment."""
    l = lines(df).withColumn("body", F.trim(F.regexp_replace("line", "#.*$", ""))).where("body <> ''")  # noqa: E741
    w = F.split("body", r"\s+")
    at = lambda i: F.try_element_at(F.col("w"), F.lit(i))
    number = lambda c: F.when(F.lower(c).rlike("^0x[0-9a-f]+$"), F.conv(F.substring(c, 3, 16), 16, 10).cast("long")).otherwise(F.expr("cast(null as bigint)"))
    op, read, full = at(1), at(1) == "read_reg", F.size("w") == 5
    return l.withColumn("w", w).select(
        *[c for c in df.columns if c != "text"], "line_no", op.alias("op"), number(at(2)).alias("addr"), F.when(op == "write_reg", number(at(3))).when(read, number(F.when(full, at(5)).otherwise(at(4)))).alias("data"),
        F.when(read, number(at(3))).alias("mask"), F.when(read, F.when(full, at(4)).otherwise("==")).alias("cmp"), F.when(read, 50000).alias("polls"), F.regexp_extract("line", r"#\s*(\S+)", 1).alias("register"),
    )


def classify_sim_log(log: DataFrame, tests: DataFrame) -> DataFrame:
    """State of each test from its log: FAILED on errors, PASSED on its mark, RUNNING, or NOTRUN without a log."""
    hit = lambda p: F.count(F.when(F.lower("line").rlike(p), 1))
    got = log.groupBy("test").agg(hit(r"\berror\b").alias("errors"), hit(r"\bfatal\b").alias("fatals"), F.bool_or(F.col("line").contains("TEST PASSED")).alias("_p"))
    out = tests.join(got, "test", "left")
    state = F.when(F.col("errors").isNull(), "NOTRUN").when(F.col("errors") + F.col("fatals") > 0, "FAILED").when(F.col("_p"), "PASSED").otherwise("RUNNING")
    return out.select("test", F.coalesce("errors", F.lit(0)).alias("errors"), F.coalesce("fatals", F.lit(0)).alias("fatals"), state.alias("state"))


# --- policies and scalars ---


def disclosure_filter(texts: DataFrame, vocabulary: tuple[str, ...]) -> DataFrame:
    """Texts that show a forbidden word, in any case, with the first one shown."""
    p = "(?i)(" + "|".join(vocabulary) + ")"
    return texts.where(F.col("text").rlike(p)).withColumn("match", F.lower(F.regexp_extract("text", p, 1)))


def constraint_command_filter(scripts: DataFrame) -> DataFrame:
    return scripts.where(F.col("text").rlike(r"(?im)^\s*(" + "|".join(CONSTRAINT_COMMANDS) + r")\b"))


def command_policy(scripts: DataFrame, allowed: tuple[str, ...], budget: int) -> DataFrame:
    """Reasons per script: unknown commands, substitution, text outside the one batch, too many actions."""
    l = lines(scripts).withColumn("line", F.trim("line")).where(~F.col("line").rlike("^(#|$)"))  # noqa: E741
    w = Window.partitionBy("script_id").orderBy("line_no")
    word = F.regexp_extract("line", r"^(\S+)", 1)
    depth = F.sum(F.when(word == "begin", 1).when(word == "end", -1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    l = l.withColumns({"word": word, "depth": depth})  # noqa: E741
    n = lambda test: F.count(F.when(test, 1))
    action = ~F.col("word").isin("begin", "end")
    s = l.groupBy("script_id").agg(n(~F.col("word").isin(*allowed, "begin", "end")).alias("unknown"), n(F.col("line").rlike(r"[\[\]$;\\]")).alias("subst"), n(F.col("word") == "begin").alias("opens"), n(F.col("word") == "end").alias("closes"), n(action & (F.col("depth") != 1)).alias("outside"), n(action).alias("actions"))
    reasons = F.array_compact(F.array(F.when(F.col("unknown") > 0, "unknown_command"), F.when(F.col("subst") > 0, "substitution"), F.when((F.col("opens") != 1) | (F.col("closes") != 1), "batch"), F.when(F.col("outside") > 0, "outside_batch"), F.when(F.col("actions") > budget, "budget")))
    return s.select("script_id", "actions", reasons.alias("reasons"))


def normalize_code(col: Column) -> Column:
    """LF line ends, no blanks at line ends, none around the text."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(col, "\r\n?", "\n"), r"[ \t]+(\n|$)", "$1"), r"^\s+|\s+$", "")


def normalize_netlist_hash(col: Column) -> Column:
    """sha256 of a netlist without comments and with single spaces."""
    bare = F.regexp_replace(F.regexp_replace(col, r"(?s)/\*.*?\*/", " "), r"//[^\n]*", " ")
    return F.sha2(F.trim(F.regexp_replace(bare, r"\s+", " ")), 256)


def normalize_timestamp_lines(pairs: DataFrame) -> DataFrame:
    """Are two texts equal as they are, and after comment lines with a time of day are masked? How many lines were?"""
    stamp = r"^\s*#.*\d{2}:\d{2}:\d{2}"
    mask = lambda c: F.transform(F.split(c, "\n"), lambda x: F.when(x.rlike(stamp), "#TIME").otherwise(x))
    n = lambda c: F.size(F.filter(F.split(c, "\n"), lambda x: x.rlike(stamp)))
    return pairs.withColumns({"raw_equal": F.col("left") == F.col("right"), "normalized_equal": mask("left") == mask("right"), "n_left": n("left").cast("long"), "n_right": n("right").cast("long")})


def render_instruction(headers: DataFrame, targets: DataFrame) -> DataFrame:
    """Prompt text: the case's header line, then its targets in order."""
    t = targets.groupBy("case_id").agg(F.array_sort(F.collect_list(F.struct("seq", F.format_string("- %s slack %.6f ns", F.col("endpoint"), F.col("slack_ns")).alias("line")))).alias("t"))
    body = F.array_join(F.transform(F.coalesce("t", F.expr("cast(array() as array<struct<seq:bigint,line:string>>)")), lambda x: x["line"]), "\n")
    return headers.join(t, "case_id", "left").select("case_id", F.concat_ws("\n", F.col("header"), F.nullif(body, F.lit(""))).alias("prompt"))


def render_evidence(headers: DataFrame, targets: DataFrame, cells: DataFrame, least: int = 1) -> DataFrame:
    """Prompt text with evidence: the case's header line, its targets in order and below each its cells, the slowest first: case_id, prompt, reasons.

    ``targets``: case_id, seq, endpoint, slack_ns; ``cells``: case_id, endpoint, instance, pin, ref, delay_ns, ties by instance and pin. Reasons against a case: ``no_targets``, ``few_cells`` (a target with
    fewer than ``least``), ``malformed_cell`` (a field that is null or empty, or a delay that isn't positive). A refused case has its prompt too, where null fields are left blank; cells of no target are left out.
    """
    sound = (F.length("instance") > 0) & (F.length("pin") > 0) & (F.length(F.col("ref").cast("string")) > 0) & (F.col("delay_ns") > 0) & (F.col("delay_ns") < float("inf"))
    place = F.row_number().over(Window.partitionBy("case_id", "endpoint").orderBy(F.desc_nulls_last("delay_ns"), "instance", "pin"))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    line = F.concat(F.lit("  "), F.col("k").cast("string"), F.lit(". "), text("instance"), F.lit(" pin "), text("pin"), F.lit(" ref "), text("ref"), F.lit(" delay "), F.coalesce(F.format_string("%.6f", "delay_ns"), F.lit("")), F.lit(" ns"))
    own = cells.withColumn("k", place).groupBy("case_id", "endpoint").agg(F.array_sort(F.collect_list(F.struct("k", line.alias("line")))).alias("c"), F.count("*").alias("n"), F.bool_and(F.coalesce(sound, F.lit(False))).alias("sound"))
    both = targets.join(own, ["case_id", "endpoint"], "left")
    said = F.concat_ws("\n", F.format_string("- %s slack %.6f ns", F.col("endpoint"), F.col("slack_ns")), F.array_join("c.line", "\n"))
    t = both.groupBy("case_id").agg(F.array_sort(F.collect_list(F.struct("seq", said.alias("line")))).alias("t"), F.bool_or(F.coalesce("n", F.lit(0)) < least).alias("few"), F.bool_or(~F.coalesce("sound", F.lit(True))).alias("bad"))
    reasons = F.array_compact(F.array(F.when(F.col("t").isNull(), "no_targets"), F.when(F.col("few"), "few_cells"), F.when(F.col("bad"), "malformed_cell")))
    return headers.join(t, "case_id", "left").select("case_id", F.concat_ws("\n", F.col("header"), F.array_join("t.line", "\n")).alias("prompt"), reasons.alias("reasons"))


def chat_assembly(turns: DataFrame) -> DataFrame:
    """Ordered turns to an array of messages; an assistant turn is its text and, below, its fenced code if any."""
    content = F.when((F.col("role") == "assistant") & F.col("code").isNotNull(), F.concat(F.col("text"), F.lit("\n\n```tcl\n"), F.col("code"), F.lit("\n```"))).otherwise(F.col("text"))
    rows = F.array_sort(F.collect_list(F.struct("turn", "role", content.alias("content"))))
    return turns.groupBy("conv_id").agg(F.transform(rows, lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))


# --- registered queries: texts are made from tables and read back ---


def _reports(t) -> DataFrame:
    s = F.round(F.col("slack_ns") * 1e8).cast("long")
    number = F.concat(F.when(s < 0, "-").otherwise(""), F.floor(F.abs(s) / 100000000).cast("string"), F.lit("."), F.lpad((F.abs(s) % 100000000).cast("string"), 8, "0"))
    block = F.concat(F.lit("Path "), F.col("path_id").cast("string"), F.when(s < 0, ": VIOLATED").otherwise(": MET"), F.lit(" Setup Check with Pin x/CK\n"), F.lit("Endpoint:   e"), F.col("endpoint").cast("string"), F.lit("\nBeginpoint: b"), F.col("beginpoint").cast("string"), F.lit("\nAnalysis View: v"), F.col("analysis"), F.when(F.col("analysis") == "F", "\n= Slack Time    ").otherwise("\n  Slack Time  "), number, F.lit("\n"))
    return t.paths.select("endpoint", "path_id", block.alias("b")).groupBy(F.col("endpoint").alias("report")).agg(F.concat(F.lit("# version 1\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("path_id", "b"))), lambda x: x["b"]), "")).alias("text"))


query("parse_timing_paths", "SELECT endpoint AS report, path_id AS path_no, 'e' || endpoint AS endpoint, 'b' || beginpoint AS beginpoint, 'v' || analysis AS view, slack_ns, '' AS reasons FROM {paths}")(
    lambda t: parse_timing_paths(_reports(t)).select("report", "path_no", "endpoint", "beginpoint", "view", "slack_ns", F.array_join("reasons", ",").alias("reasons"))
)
query("parse_path_points", "SELECT path_id AS report, 'e' || path_id AS endpoint, instance, CASE WHEN delay_kind = 'cell' THEN 'INV_X1' ELSE 'NAND_X2' END AS ref, delay_ns * 1e8 AS delay FROM (SELECT *, row_number() OVER (PARTITION BY path_id, instance ORDER BY delay_ns DESC, point_index) AS k FROM {points} WHERE delay_kind <> 'net' AND point_index > 1) WHERE k = 1")(
    lambda t: parse_path_points(
        t.deal("lineitem", "l_orderkey").points.groupBy("path_id").agg(F.array_sort(F.collect_list(F.struct("point_index", F.concat(
            F.lit("| "), F.when(F.col("point_index") == 1, "b/Q").otherwise(F.concat("instance", F.lit("/Z ->"))), F.lit(" | ^ | n1 | "), F.when(F.col("delay_kind") == "cell", "INV_X1").when(F.col("delay_kind") == "net", "TLATX1").otherwise("NAND_X2"),
            F.lit(" | "), F.round(F.col("delay_ns") * 1e8).cast("long").cast("string"), F.lit(" | 1.0 | 2.0 |"),
        ).alias("l")))).alias("r")).select(F.col("path_id").alias("report"), F.concat(F.lit("Path 1: MET Setup Check with Pin c/CK\nEndpoint: e"), F.col("path_id").cast("string"), F.lit("\nBeginpoint: b/Q\n Timing Path:\n| a/Z | ^ | n | INV_X1 | 9 | 1 | 2 |\n"), F.array_join(F.transform("r", lambda x: x["l"]), "\n")).alias("text")),
        max_cells=1000,
    ).select("report", "endpoint", "instance", "ref", F.col("delay_ns").alias("delay"))
)
query("parse_drv_counts", "SELECT o_custkey AS report, 'max_transition' AS \"check\", CASE WHEN count(*) % 7 = 0 THEN 0 WHEN count(*) % 5 = 0 THEN -1 ELSE count(*) END AS n FROM orders GROUP BY o_custkey")(
    lambda t: parse_drv_counts(
        t.orders.groupBy(F.col("o_custkey").alias("report")).agg(F.count("*").alias("n"), F.collect_list(F.format_string(" | u/i%d/A | 0.5 | 0.6 | -0.1 | R |", "o_orderkey")).alias("v"))
        .select("report", F.concat(F.lit("Check type : max_transition\n"), F.when(F.col("n") % 7 == 0, "No violations found\n").otherwise(F.array_join("v", "\n")), F.when((F.col("n") % 5 == 0) & (F.col("n") % 7 != 0), "\n | u/x | 1 | 1 | 0.0 | R |").otherwise("")).alias("text"))
    ).withColumn("n", F.coalesce("n", F.lit(-1)).cast("long"))
)
query("parse_connectivity", "SELECT p_partkey AS report, CASE p_partkey % 4 WHEN 0 THEN 0 WHEN 1 THEN p_size + 2 WHEN 2 THEN p_size + 5 ELSE -1 END::BIGINT AS n FROM part")(
    lambda t: parse_connectivity(t.part.select(
        F.col("p_partkey").alias("report"),
        F.when(F.col("p_partkey") % 4 == 0, F.lit("Found no problems or warnings.")).when(F.col("p_partkey") % 4 == 1, F.format_string("Found %d problems and 2 warnings.", "p_size"))
        .when(F.col("p_partkey") % 4 == 2, F.format_string("%d Problem(s) (IMPVFC-92)\n5 Problem(s) (IMPVFC-96)\n%d total info(s) created", "p_size", F.col("p_size") + 5)).otherwise(F.format_string("%d Problem(s) (IMPVFC-92)\n%d total info(s) created", "p_size", F.col("p_size") + 5)).alias("text"),
    )).withColumn("n", F.coalesce("n", F.lit(-1)).cast("long"))
)
query("parse_drc_categories", "SELECT o_custkey AS report, o_custkey % 3 <> 0 AS complete, CASE o_orderstatus WHEN 'F' THEN 'SHORT' WHEN 'O' THEN 'SPACING' ELSE 'WIDTH' END AS category, count(*) AS n FROM orders GROUP BY 1, 2, 3")(
    lambda t: parse_drc_categories(
        t.orders.groupBy(F.col("o_custkey").alias("report")).agg(F.count("*").alias("k"), F.collect_list(F.concat(F.when(F.col("o_orderstatus") == "F", "SHORT").when(F.col("o_orderstatus") == "O", "SPACING").otherwise("WIDTH"), F.lit(": ( Metal ) of net n"))).alias("l"))
        .select("report", F.concat(F.array_join("l", "\nBounds : (1, 2)\n"), F.lit("\n  Total Violations : "), (F.col("k") + F.when(F.col("report") % 3 == 0, 1).otherwise(0)).cast("string"), F.lit(" Viols.\n")).alias("text"))
    )
)
query("parse_kv_marker", "SELECT o_orderkey AS id, round(o_totalprice) AS tns, o_orderstatus AS status, CASE WHEN o_orderkey % 5 = 0 THEN 'wns' ELSE '' END AS reasons FROM orders")(
    lambda t: parse_kv_marker(t.orders.select(F.col("o_orderkey").alias("id"), F.concat(F.lit("noise\nMARK tns="), F.round("o_totalprice").cast("long").cast("string"), F.lit(" status="), F.col("o_orderstatus"), F.when(F.col("o_orderkey") % 5 == 0, " wns=?").otherwise(" wns=1")).alias("text")), "MARK", ["tns", "wns"], ["status"])
    .select("id", "tns", "status", F.array_join("reasons", ",").alias("reasons"))
)
def _fixes(t) -> DataFrame:
    t.deal("lineitem", "l_orderkey")
    o = t.operations.groupBy("case_id", "kind").agg(F.array_sort(F.collect_list(F.struct("seq", F.format_string("ecoChangeCell -inst {i%d} -cell {C%d}", "instance", "new_ref").alias("l")))).alias("o"))
    end = F.when(F.size("o") % 4 == 3, "\ncreate_clock x").otherwise("")
    return o.select("case_id", F.concat_ws("-", F.col("case_id").cast("string"), F.col("kind")).alias("script_id"), F.size("o").cast("long").alias("n"), F.concat_ws("\n", F.lit("# fix"), F.lit(OPEN_BATCH), F.array_join(F.transform("o", lambda x: x["l"]), "\n"), F.lit(CLOSE_BATCH), F.concat(F.lit(LEGALIZE), end)).alias("text"))


query("parse_fix_operations", "SELECT case_id || '-' || kind AS script_id, 'i' || instance AS instance, 'C' || new_ref AS cell, count(*) AS n FROM {operations} GROUP BY ALL")(
    lambda t: parse_fix_operations(_fixes(t).drop("n")).where("instance is not null and not refused").groupBy("case_id", "script_id", "instance", "cell").agg(F.count("*").alias("n")).drop("case_id")
)
query("fix_script_reasons", "WITH s AS (SELECT case_id || '-' || kind AS script_id, count(*) AS n, count(DISTINCT instance) AS d FROM {operations} GROUP BY ALL) SELECT script_id, n AS resizes, concat_ws(',', CASE WHEN n % 4 = 3 THEN 'refused_line' END, CASE WHEN n % 4 = 3 THEN 'last_line' END, CASE WHEN n % 5 = 4 THEN 'resize_count' END, CASE WHEN d < n THEN 'resized_twice' END) AS reasons FROM s")(
    lambda t: fix_script_reasons(_fixes(t).select("script_id", "text"), _fixes(t).select("script_id", F.when(F.col("n") % 5 == 4, F.col("n") + 1).otherwise(F.col("n")).alias("n"))).withColumn("reasons", F.array_join("reasons", ","))
)
query("parse_catalog_cards", "SELECT p_partkey AS card, replace(p_type, ' ', '_') AS shape, CAST(p_size AS BIGINT) AS target_count, CAST(p_size * 80 AS BIGINT) AS severity_ps, greatest(10.0, round(p_size * 12.0, 6))::DOUBLE AS tolerance_ps, p_partkey % 9 <> 0 AS consistent FROM part")(
    lambda t: parse_catalog_cards(t.part.select(F.col("p_partkey").alias("card"), F.format_string("# card\n- shape: %s\n- targets: %d\n- severity: %d%% = %d ps, at least 10 ps\n", F.replace("p_type", F.lit(" "), F.lit("_")), "p_size", F.col("p_size") + F.when(F.col("p_partkey") % 9 == 0, 1).otherwise(0), F.col("p_size") * 80).alias("text"))).withColumn("tolerance_ps", F.round("tolerance_ps", 6))
)
query("extract_code_fence", "SELECT conv_id, turn, 'fix ' || turn AS code, concat_ws(',', CASE WHEN turn % 4 = 3 THEN 'trailing_text' END, CASE WHEN turn % 3 = 2 THEN 'sentences' END) AS reasons FROM conversations WHERE role = 'assistant'")(
    lambda t: extract_code_fence(t.conversations.where("role = 'assistant'").select("conv_id", "turn", F.concat(F.when(F.col("turn") % 3 == 2, "The path is slow").otherwise("The path is slow. Use a stronger cell."), F.lit("\n```tcl\nfix "), F.col("turn").cast("string"), F.lit("```"), F.when(F.col("turn") % 4 == 3, " more").otherwise("")).alias("text")))
    .select("conv_id", "turn", "code", F.array_join("reasons", ",").alias("reasons"))
)
query("parse_drive_name", "SELECT p_partkey, p_brand AS stem, CASE WHEN p_size % 2 = 0 THEN p_size + 0.5 ELSE p_size END::DOUBLE AS drive, CASE WHEN p_size % 3 = 0 THEN 'M' ELSE '' END AS flavor, 'T' || p_size AS tail FROM part")(
    lambda t: parse_drive_name(t.part.select("p_partkey", F.concat(F.col("p_brand"), F.lit("_X"), F.col("p_size").cast("string"), F.when(F.col("p_size") % 2 == 0, "P5").otherwise(""), F.when(F.col("p_size") % 3 == 0, "M").otherwise(""), F.lit("_T"), F.col("p_size").cast("string")).alias("name")), "name").drop("name")
)
query("parse_trace_commands", "SELECT trace, seq AS line_no, op, addr, CASE WHEN op = 'wait' THEN -1 ELSE data END AS data, CASE WHEN op = 'read_reg' THEN 255 ELSE -1 END::BIGINT AS mask, CASE WHEN op = 'read_reg' THEN '==' ELSE '' END AS cmp, 'u.r' || addr AS register FROM (SELECT trace, row_number() OVER (PARTITION BY trace ORDER BY seq) - 1 AS seq, op, addr, data FROM {trace})")(
    lambda t: parse_trace_commands(t.trace.groupBy("trace").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", F.concat(F.col("op"), F.lit(" 0x"), F.hex("addr"), F.when(F.col("op") == "read_reg", " 0xFF").otherwise(""), F.when(F.col("op") == "wait", "").otherwise(F.concat(F.lit(" 0x"), F.hex("data"))), F.lit(" # u.r"), F.col("addr").cast("string")).alias("l")))), lambda x: x["l"]), "\n").alias("text")))
    .select("trace", F.col("line_no").cast("long").alias("line_no"), "op", "addr", F.coalesce("data", F.lit(-1)).cast("long").alias("data"), F.coalesce("mask", F.lit(-1)).cast("long").alias("mask"), F.coalesce("cmp", F.lit("")).alias("cmp"), "register")
)
query("classify_sim_log", "WITH g AS (SELECT user_id AS test, count(CASE WHEN event_type = 'view' AND value > 60 THEN 1 END) AS errors, count(CASE WHEN event_type = 'click' AND value > 70 THEN 1 END) AS fatals, bool_or(event_type = 'purchase') AS p FROM events WHERE user_id % 10 <> 0 GROUP BY user_id), t AS (SELECT DISTINCT user_id AS test FROM events) SELECT t.test, coalesce(errors, 0) AS errors, coalesce(fatals, 0) AS fatals, CASE WHEN g.test IS NULL THEN 'NOTRUN' WHEN errors + fatals > 0 THEN 'FAILED' WHEN p THEN 'PASSED' ELSE 'RUNNING' END AS state FROM t LEFT JOIN g ON g.test = t.test")(
    lambda t: classify_sim_log(t.events.where("user_id % 10 <> 0").select(F.col("user_id").alias("test"), F.when((F.col("event_type") == "view") & (F.col("value") > 60), "an Error here").when((F.col("event_type") == "click") & (F.col("value") > 70), "FATAL: x").when(F.col("event_type") == "purchase", "TEST PASSED").otherwise("ok").alias("line")), t.events.select(F.col("user_id").alias("test")).distinct())
)
query("disclosure_filter", "SELECT doc_id, lower(regexp_extract(text, '(?i)(idiot|clown|scum)', 1)) AS match FROM documents WHERE regexp_matches(text, '(?i)(idiot|clown|scum)')")(lambda t: disclosure_filter(t.documents, ("idiot", "clown", "scum")).select("doc_id", "match"))


def _scripts(t) -> DataFrame:
    line = F.when(F.col("l_linenumber") == 3, "set_false_path -to x").when(F.col("l_discount") > 0.09, "resize [get a]").otherwise("resize a b")
    s = t.lineitem.groupBy(F.col("l_orderkey").alias("script_id")).agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("b"))
    return s.select("script_id", F.concat(F.lit("# fix\nbegin\n"), F.col("b"), F.when(F.col("script_id") % 5 == 0, "\n").otherwise("\nend\n")).alias("text"))


query("constraint_command_filter", "SELECT DISTINCT l_orderkey AS script_id FROM lineitem WHERE l_linenumber = 3")(lambda t: constraint_command_filter(_scripts(t)).select("script_id"))
query("command_policy", "SELECT l_orderkey AS script_id, count(*) AS actions, concat_ws(',', CASE WHEN count(CASE WHEN l_linenumber = 3 THEN 1 END) > 0 THEN 'unknown_command' END, CASE WHEN count(CASE WHEN l_linenumber <> 3 AND l_discount > 0.09 THEN 1 END) > 0 THEN 'substitution' END, CASE WHEN l_orderkey % 5 = 0 THEN 'batch' END, CASE WHEN count(*) > 6 THEN 'budget' END) AS reasons FROM lineitem GROUP BY l_orderkey")(
    lambda t: command_policy(_scripts(t), ("resize",), 6).withColumn("reasons", F.array_join("reasons", ","))
)
query("normalize_code", r"SELECT doc_id, sha256(regexp_replace(regexp_replace(regexp_replace(text || '  ' || chr(13) || chr(10), '\r\n?', chr(10), 'g'), '[ \t]+(\n|$)', '\1', 'g'), '^\s+|\s+$', '', 'g')) AS h FROM documents")(
    lambda t: t.documents.select("doc_id", F.sha2(normalize_code(F.concat("text", F.lit("  \r\n"))), 256).alias("h"))
)
query("normalize_netlist_hash", r"SELECT doc_id, sha256(trim(regexp_replace(regexp_replace(regexp_replace('module a ' || text || ' end', '(?s)/\*.*?\*/', ' ', 'g'), '//[^\n]*', ' ', 'g'), '\s+', ' ', 'g'))) AS h FROM documents")(
    lambda t: t.documents.select("doc_id", normalize_netlist_hash(F.concat(F.lit("module /* b\n */ a "), F.col("text"), F.lit(" end"))).alias("h"))
)
query("normalize_timestamp_lines", "SELECT event_id, event_id % 3 = 0 AS raw_equal, event_id % 5 <> 0 OR event_id % 3 = 0 AS normalized_equal, CAST(1 AS BIGINT) AS n_left, CAST(1 AS BIGINT) AS n_right FROM events")(
    lambda t: normalize_timestamp_lines(t.events.select("event_id", F.concat(F.lit("# at 10:00:00\nset "), F.col("event_type")).alias("left"), F.concat(F.when(F.col("event_id") % 3 == 0, "# at 10:00:00\nset ").otherwise("# at 11:22:33\nset "), F.col("event_type"), F.when((F.col("event_id") % 5 == 0) & (F.col("event_id") % 3 != 0), " x").otherwise("")).alias("right"))).drop("left", "right")
)
query("render_instruction", "SELECT c.case_id, sha256('Case ' || c.case_id || coalesce(chr(10) || t.t, '')) AS prompt FROM {specs} c LEFT JOIN (SELECT endpoint AS case_id, string_agg('- p' || path_id || ' slack ' || printf('%.6f', floor(round(slack_ns * 1e8) / 100) / 1e6) || ' ns', chr(10) ORDER BY path_id) AS t FROM {paths} GROUP BY endpoint) t ON t.case_id = c.case_id")(
    lambda t: render_instruction(t.specs.select("case_id", F.concat(F.lit("Case "), F.col("case_id").cast("string")).alias("header")), t.paths.select(F.col("endpoint").alias("case_id"), F.col("path_id").alias("seq"), F.concat(F.lit("p"), F.col("path_id").cast("string")).alias("endpoint"), (F.floor(F.round(F.col("slack_ns") * 1e8) / 100) / 1e6).alias("slack_ns"))).withColumn("prompt", F.sha2("prompt", 256))
)
query("render_evidence", """WITH c AS (SELECT q.path_id, q.instance, 'P' || q.point_index AS pin, q.ref, floor(round(q.delay_ns * 1e8) / 100) / 1e6 AS d FROM {points} q WHERE q.delay_kind = 'cell'),
    k AS (SELECT *, row_number() OVER (PARTITION BY path_id ORDER BY d DESC, instance, pin) AS k FROM c),
    l AS (SELECT path_id, string_agg('  ' || k || '. ' || instance || ' pin ' || pin || ' ref ' || ref || ' delay ' || printf('%.6f', d) || ' ns', chr(10) ORDER BY k) AS t, count(*) AS n FROM k GROUP BY path_id),
    t AS (SELECT p.endpoint AS case_id, string_agg('- p' || p.path_id || ' slack ' || printf('%.6f', floor(round(slack_ns * 1e8) / 100) / 1e6) || ' ns' || coalesce(chr(10) || l.t, ''), chr(10) ORDER BY p.path_id) AS t, bool_or(coalesce(n, 0) < 2) AS few FROM {paths} p LEFT JOIN l ON l.path_id = p.path_id GROUP BY p.endpoint)
    SELECT s.case_id, sha256('Case ' || s.case_id || coalesce(chr(10) || t.t, '')) AS prompt, CASE WHEN t.case_id IS NULL THEN 'no_targets' WHEN few THEN 'few_cells' ELSE '' END AS reasons FROM {specs} s LEFT JOIN t ON t.case_id = s.case_id""")(
    lambda t: render_evidence(
        t.specs.select("case_id", F.concat(F.lit("Case "), F.col("case_id").cast("string")).alias("header")),
        t.paths.select(F.col("endpoint").alias("case_id"), F.col("path_id").alias("seq"), F.concat(F.lit("p"), F.col("path_id").cast("string")).alias("endpoint"), (F.floor(F.round(F.col("slack_ns") * 1e8) / 100) / 1e6).alias("slack_ns")),
        t.points.where("delay_kind = 'cell'").join(t.paths.select("path_id", F.col("endpoint").alias("case_id")), "path_id").select("case_id", F.concat(F.lit("p"), F.col("path_id").cast("string")).alias("endpoint"), "instance", F.concat(F.lit("P"), F.col("point_index").cast("string")).alias("pin"), "ref", (F.floor(F.round(F.col("delay_ns") * 1e8) / 100) / 1e6).alias("delay_ns")), 2,
    ).select("case_id", F.sha2("prompt", 256).alias("prompt"), F.array_join("reasons", ",").alias("reasons"))
)
query("chat_assembly", "SELECT conv_id, count(*) AS n, sha256(string_agg(role || ':' || text || CASE WHEN role = 'assistant' AND turn % 2 = 1 THEN chr(10) || chr(10) || '```tcl' || chr(10) || 'fix' || chr(10) || '```' ELSE '' END, chr(10) ORDER BY turn)) AS h FROM conversations GROUP BY conv_id")(
    lambda t: chat_assembly(t.conversations.withColumn("code", F.when(F.col("turn") % 2 == 1, "fix"))).select("conv_id", F.size("messages").cast("long").alias("n"), F.sha2(F.array_join(F.transform("messages", lambda m: F.concat_ws(":", m["role"], m["content"])), "\n"), 256).alias("h"))
)
