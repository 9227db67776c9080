"""String helpers, titles and labels as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space of Unicode, as trimming and splitting of texts know it.
BLANKS = (" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
          "\u2028\u2029\u202f\u205f\u3000")
LINE_BREAKS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"

# Sentence separators of a title, in the order they are looked for.
SEPARATORS = ("。", "！", "？", ". ", "! ", "? ", "\n")
# End marks of which one is dropped, and quotes stripped from a label.
END_MARKS = ("。", ".", "!", "?", "！", "？", ":", "：")
QUOTES = "\"'`「」『』"
BULLETS = "-•*0123456789. "
# Openings and fragments that mark a label as chatter, and the one literal
# that is always good.
BAD_PREFIXES = (
    "<", "[", "(", "the ", "i ", "i'", "it ", "it'", "let ", "let's", "we ", "we'",
    "looking", "let me", "sure", "okay", "ok,", "hi,", "hi!", "hello",
    "yes,", "no,", "sorry", "waiting", "based on", "from the",
    "我需要", "我看到", "我注意", "我会", "这段", "这个", "这是", "这条",
    "看起来", "根据", "请告诉", "请提供", "你好",
)
BAD_FRAGMENTS = (
    "approval", "permission", "transcript", "got cut off", "truncated",
    "incomplete", "could you clarify", "what would you", "what can i",
    "请确认", "需要确认", "需要权限", "请提供更多",
)
GOOD_LITERAL = "(闲聊)"
UNSPECIFIED = "unspecified task"
# Openings of automatic notice lines put before a label.
NOTICE_PREFIXES = ("📥", "[task-summary]", "📤 uploaded")
# Fixed value: the marker line an agent writes to name its task.
TASK_SUMMARY = r"(?imd)^\s*\[task-summary\]\s*[:：]\s*(.+?)\s*$"
# Openings of wrapper turns that are no real request or answer.
WRAPPER_PREFIXES = (
    "<environment_context>", "<local-command-caveat>", "<command-message>", "<command-name>",
)
BACKFILL_USER_MARKS = ("<environment_context>", "🔧", "📤", "💭", "🖼️", "[")
BACKFILL_ASSISTANT_MARKS = ("🔧", "💭")


def pipe(value: Column, *steps) -> Column:
    """Pass a value through functions, evaluating it once per step. Each step may use its
    argument many times without copying the expression that made it."""
    boxed = F.array(value)
    for f in steps:
        boxed = F.transform(boxed, f)
    return boxed.getItem(0)


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(BLANKS))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(BLANKS))


def lstrip(c: Column) -> Column:
    return F.ltrim(c, F.lit(BLANKS))


def is_blank(c: Column) -> Column:
    return F.coalesce(strip(c) == "", F.lit(True))


def flatten_ws(c: Column) -> Column:
    """Runs of white space become one blank; ends are trimmed."""
    return F.trim(F.regexp_replace(c, f"[{BLANKS}]+", " "))


def _any_of(parts) -> str:
    return "(?:" + "|".join(f"\\Q{p}\\E" for p in parts) + ")"


def starts_with_any(c: Column, prefixes) -> Column:
    """One anchored pattern over the first characters only."""
    longest = max(len(p) for p in prefixes)
    return F.rlike(F.substring(c, 1, longest), F.lit(r"\A" + _any_of(prefixes)))


def contains_any(c: Column, parts) -> Column:
    return F.rlike(c, F.lit(_any_of(parts)))


def ends_with_any(c: Column, suffixes) -> Column:
    return F.rlike(c, F.lit(_any_of(suffixes) + r"\z"))


def clip(c: Column, limit: int, keep: int | None = None) -> Column:
    """Text over ``limit`` characters is cut to ``keep`` and marked."""
    cut = F.concat(F.substring(c, 1, limit if keep is None else keep), F.lit("…"))
    return F.when(F.length(c) > limit, cut).otherwise(c)


def drop_end_mark(c: Column) -> Column:
    return F.regexp_replace(c, "[" + "".join(END_MARKS) + r"]\z", "")


def looks_bad_title(label: Column) -> Column:
    return pipe(
        F.coalesce(label, F.lit("")),
        lambda x: F.struct(x.alias("raw"), strip(F.lower(x)).alias("low")),
        lambda x: F.when(x["raw"] == "", True).when(x["raw"] == GOOD_LITERAL, False).otherwise(
            starts_with_any(x["low"], BAD_PREFIXES) | contains_any(x["low"], BAD_FRAGMENTS)
            | ends_with_any(x["raw"], ("…", "..."))))


def _first_line(text: Column) -> Column:
    return strip(F.regexp_extract(strip(text), f"^[^{LINE_BREAKS}]*", 0))


def heuristic_title(query: Column, default: Column | None = None) -> Column:
    """First sentence of the first line, at most 120 characters read, at most 70 kept."""
    default = F.lit(UNSPECIFIED) if default is None else default

    def cut(head: Column) -> Column:
        ends = [F.when(F.locate(sep, head) > 1, F.locate(sep, head) - 1 + len(sep))
                for sep in SEPARATORS]
        return F.substring(head, F.lit(1), F.coalesce(F.least(*ends), F.length(head)))

    def shorten(t: Column) -> Column:
        return (F.when(t == "", default)
                .when(F.length(t) > 70, F.concat(rstrip(F.substring(t, 1, 69)), F.lit("…")))
                .otherwise(t))

    return pipe(F.coalesce(query, F.lit("")), lambda t: F.substring(_first_line(t), 1, 120),
                cut, flatten_ws, shorten)


def marker_label(content: Column, limit: int = 60, reject_bad: bool = True) -> Column:
    """Label of the last task-summary line in a turn, or NULL."""
    def accept(label: Column) -> Column:
        good = (label != "") & ~looks_bad_title(label) if reject_bad else label != ""
        return F.when(good, clip(label, limit))

    found = pipe(
        content,
        lambda c: F.try_element_at(F.regexp_extract_all(c, F.lit(TASK_SUMMARY), 1), F.lit(-1)),
        lambda m: strip(F.trim(flatten_ws(m), F.lit(QUOTES))),
        lambda m: strip(drop_end_mark(m)), accept)
    return F.when(F.rlike(content, F.lit(r"(?i)\[task-summary\]")), found)


def clean_label(raw: Column, notices: tuple[str, ...] = ()) -> Column:
    """One usable line out of a generated label, or NULL. ``notices`` are lower-case phrases
    that mark further automatic lines."""
    def is_notice(line: Column) -> Column:
        hit = (line == "") | starts_with_any(line, NOTICE_PREFIXES)
        return hit | contains_any(F.lower(line), notices) if notices else hit

    def first_line(text: Column) -> Column:
        lines = F.transform(F.split(strip(text), f"\r\n|[{LINE_BREAKS}]"), strip)
        return F.coalesce(F.try_element_at(F.filter(lines, lambda x: ~is_notice(x)), F.lit(1)),
                          F.lit(""))

    def accept(label: Column) -> Column:
        bad = F.lower(label).isin("", "(no task)", "(none)") | looks_bad_title(label)
        return F.when(~bad, clip(label, 60, 59))

    return pipe(
        raw, first_line, lambda x: strip(F.ltrim(x, F.lit(BULLETS))),
        lambda x: strip(F.trim(x, F.lit(QUOTES))), lambda x: flatten_ws(drop_end_mark(x)), accept)


def backfill_title(first_user: Column, source: Column) -> Column:
    """Heuristic title after leading fence, quote and tag lines are dropped."""
    body = F.regexp_replace(strip(F.coalesce(first_user, F.lit(""))),
                            r"\A(?:(?:```|>|<)[^\n]*\n\s*)+", "")
    return heuristic_title(body, F.concat(source, F.lit(" session")))


def coerce_role(role: Column, name: Column | None = None) -> Column:
    r = strip(F.lower(F.coalesce(role, F.lit(""))))
    named = F.coalesce(name, F.lit("")) != "" if name is not None else F.lit(False)
    return (F.when(r.isin("user", "human"), "user")
             .when(r.isin("assistant", "ai", "bot", "agent"), "assistant")
             .when(r == "system", "system")
             .when(r.isin("tool", "function"), "tool")
             .when(named, "assistant").otherwise("user"))


def spaced_json(c: Column) -> Column:
    """Compact JSON text with one blank after every structural comma and colon."""
    tokens = F.regexp_extract_all(c, F.lit(r'"(?:[^"\\]|\\.)*+"|[^"]+'), 0)
    return F.array_join(F.transform(tokens, lambda t: F.when(F.startswith(t, F.lit('"')), t).otherwise(
        F.regexp_replace(t, "([,:])", "$1 "))), "")


def format_assistant(content: Column, tool_calls: Column | None = None) -> Column:
    """Content followed by one ``[Tool: name] input`` line per call."""
    if tool_calls is None:
        return strip(F.coalesce(content, F.lit("")))
    calls = F.transform(tool_calls, lambda c: F.concat(
        F.lit("[Tool: "), F.coalesce(c["name"], F.lit("?")), F.lit("] "),
        F.substring(spaced_json(F.coalesce(c["input"], F.lit("{}"))), 1, 600)))
    lines = F.concat(F.array(F.coalesce(content, F.lit(""))), F.coalesce(calls, F.array().cast("array<string>")))
    return strip(F.array_join(F.filter(lines, lambda x: x != ""), "\n"))


def is_real_user(role: Column, content: Column) -> Column:
    return (role == "user") & ~is_blank(content) & ~starts_with_any(lstrip(content), WRAPPER_PREFIXES)


def is_real_assistant(role: Column, content: Column) -> Column:
    return (role == "assistant") & ~is_blank(content)


def is_backfill_user(role: Column, content: Column) -> Column:
    return (role == "user") & ~is_blank(content) & ~starts_with_any(lstrip(content), BACKFILL_USER_MARKS)


def is_backfill_assistant(role: Column, content: Column) -> Column:
    return (role == "assistant") & ~is_blank(content) & ~starts_with_any(
        lstrip(content), BACKFILL_ASSISTANT_MARKS)
