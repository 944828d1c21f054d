"""Line-first cleaning: judge every line, remove the failing ones, reject documents that lose too much.

A line fails as
  navigation   short pieces between separators (``|``, ``»``, ...), or a short line that is a menu word or a bare link,
  boilerplate  it holds a stock phrase of licences, consent banners or page furniture,
  symbols      symbol characters for at least every fourth word,
  shouting     all its letters are capitals and it has at least five words,
  repeated     it has a word and equals an earlier line of the document,
  punctuation  it has at least ``OPEN_WORDS`` words and its paragraph, the lines around it up to blank ones, holds no
               sentence mark; a line of wrapped prose is only a part of a sentence.
Words are what stands between ASCII white space, so indents and tabs change nothing. Lines without a word are neither
judged nor counted. Texts of any length are judged whole. A document is kept if the base rules hold (at least
``MIN_WORDS`` words, at most half of them in repeated windows of three) and the failed lines hold at most
``MAX_LOST`` of its word characters.
"""

from __future__ import annotations

import re
from collections import Counter
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breakwater.llm.common import ASCII_SPACE

# Fixed values of the rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
MAX_LOST = 0.5
OPEN_WORDS = 12
SENTENCE_MARKS = re.compile("[.!?;:…。！？।۔؟]")
SEPARATOR = re.compile(r"[ \t\r\f\v](?:[|»›•·>]|::|->)[ \t\r\f\v]")
MENU = re.compile(r"(?:home|menu|next|previous|back|share|login|log in|sign in|sign up|search|contact|about|skip to content|read more)[.:»›]?", re.I)
LINK = re.compile(r"(?:https?://|www\.)[^ \t\r\f\v]+", re.I)
BOILERPLATE = re.compile(
    r"all rights reserved|licensed under|license, version|released under the|terms of (?:use|service)|privacy policy"
    r"|accept (?:all )?cookies|uses cookies|enable javascript|lorem ipsum|click here|subscribe to our newsletter",
    re.I,
)

_RESULT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "lost_chars long, failed_lines map<string,long>, kept boolean, cleaned string"
)


class Judgement(NamedTuple):
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    base_failed: bool
    lost_chars: int
    failed_lines: list
    kept: bool
    cleaned: str | None


def word_chars(text: str) -> int:
    return len(text) - sum(map(text.count, ASCII_SPACE))


def symbols(text: str) -> int:
    return sum(map(text.count, SYMBOLS))


def repeated_words(words: list[bytes]) -> int:
    """Words inside a window of three that the text holds at least twice."""
    windows = list(zip(words, words[1:], words[2:]))
    times = Counter(windows)
    if len(times) == len(windows):
        return 0
    covered = upto = 0
    for i, window in enumerate(windows):
        if times[window] > 1:
            covered += i + 3 - max(i, upto)
            upto = i + 3
    return covered


def in_sentences(lines: list[str]) -> list[bool]:
    """For each line whether its paragraph, the lines around it up to blank ones, holds a sentence mark."""
    found, begin = [False] * len(lines), 0
    for i, line in enumerate([*lines, ""]):
        if not line.strip(ASCII_SPACE):
            found[begin:i] = [any(map(SENTENCE_MARKS.search, lines[begin:i]))] * (i - begin)
            begin = i + 1
    return found


def failure(line: str, marked: bool, ended: bool) -> str | None:
    """The rule a line with at least one word breaks.

    ``marked``: the document holds symbol characters; ``ended``: the line's paragraph holds a sentence mark.
    """
    words = len(line.encode("utf-8", "surrogatepass").split())
    if SEPARATOR.search(line) and len(SEPARATOR.findall(line)) * 4 >= words:
        return "navigation"
    if words <= 4 and (MENU.fullmatch(line.strip(ASCII_SPACE)) or LINK.fullmatch(line.strip(ASCII_SPACE))):
        return "navigation"
    if BOILERPLATE.search(line):
        return "boilerplate"
    if marked and symbols(line) * 4 >= words:
        return "symbols"
    if words >= 5 and line.isupper():
        return "shouting"
    if words >= OPEN_WORDS and not ended:
        return "punctuation"
    return None


def judge(text: str | None, cleaned: bool) -> Judgement:
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    n_symbols, repeated, all_chars = symbols(text), repeated_words(words), word_chars(text)
    failed: Counter = Counter()
    seen: set[str] = set()
    kept_lines, lost, lines = [], 0, text.split("\n")
    for line, ended in zip(lines, in_sentences(lines)):
        if not line.strip(ASCII_SPACE):
            kept_lines.append(line)
            continue
        rule = "repeated" if line in seen else failure(line, n_symbols > 0, ended)
        if line in seen:
            failed["copies"] += 1
        seen.add(line)
        if rule:
            failed[rule] += 1
            lost += word_chars(line)
        else:
            kept_lines.append(line)
    duplicates = failed.pop("copies", 0)
    base_failed = len(words) < MIN_WORDS or 100 * repeated > MAX_REPEATED_PERCENT * len(words)
    kept = not base_failed and lost <= MAX_LOST * all_chars
    return Judgement(
        len(words), all_chars, n_symbols, duplicates, repeated, base_failed, lost, list(failed.items()), kept,
        "\n".join(kept_lines) if cleaned else None,
    )


def assess(text: Column, cleaned: bool = True) -> Column:
    """A struct of counts, verdict and, if asked for, the text without its failing lines.

    A null text is judged as an empty one: no words, base rules failed, not kept, cleaned text empty. A filter on the
    verdict judges no text a second time: Spark copies only deterministic functions below the other columns, and two
    evaluations in a task would also take two Python workers, which an executor then keeps.
    """

    @F.arrow_udf(f"struct<{_RESULT.replace(' ', ':').replace(',:', ',')}>")
    def verdicts(batch):
        import pyarrow as pa

        kinds = [pa.int64()] * 5 + [pa.bool_(), pa.int64(), pa.map_(pa.string(), pa.int64()), pa.bool_(), pa.string()]
        rows = [judge(text, cleaned) for text in batch.to_pylist()]
        columns = list(zip(*rows)) if rows else [()] * len(kinds)
        return pa.StructArray.from_arrays(
            [pa.array(values, kind) for values, kind in zip(columns, kinds)], list(Judgement._fields)
        )

    return verdicts.asNondeterministic()(text)


def clean(docs: DataFrame) -> DataFrame:
    """Documents that pass, without their failing lines; ``n_chars`` follows the text. Columns stay as they are.

    Repeated rows are judged alike and all kept or all dropped; rows with a null text are dropped.
    """
    judged = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), assess(F.col("text")).alias("verdict"))
    kept = judged.where("verdict.kept")
    changed = {"text": F.col("verdict.cleaned"), "n_chars": F.char_length("verdict.cleaned").cast("long")}
    return kept.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def report(docs: DataFrame) -> DataFrame:
    """Per document its counts and verdict; other columns are not read."""
    judged = docs.select("doc_id", assess(F.col("text"), cleaned=False).alias("v"))
    return judged.select(
        "doc_id",
        *[F.col(f"v.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")],
        "v.lost_chars",
        F.coalesce(F.aggregate(F.map_values("v.failed_lines"), F.lit(0).cast("long"), lambda a, b: a + b), F.lit(0)).alias("n_failed_lines"),
    )


def _sql() -> str:
    """The report for SQL: windows over unnested lines and words instead of a walk through each text."""
    space = r"[\x20\x09-\x0D]"
    trimmed = rf"regexp_replace(line, '^{space}+|{space}+$', '', 'g')"
    return rf"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
tokens as (select r, [x for x in regexp_split_to_array(text, '{space}+') if x <> ''] as w from d),
windows as (select r, unnest(range(1, len(w) - 1)) as pos, unnest([w[i:i + 2] for i in range(1, len(w) - 1)]) as g
            from tokens where len(w) > 2),
twice as (select r, pos from (select r, pos, count(*) over (partition by r, g) as n from windows) where n > 1),
covered as (select r, count(distinct pos + step) as n from twice, (values (0), (1), (2)) s(step) group by r),
split as (select r, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as nth from d),
paragraphs as (select *, sum(case when regexp_matches(line, '[^\x20\x09-\x0D]') then 0 else 1 end)
                      over (partition by r order by nth) as paragraph from split),
sentences as (select *, bool_or(regexp_matches(line, '{SENTENCE_MARKS.pattern}')) over (partition by r, paragraph) as ended
              from paragraphs),
held as (select *, row_number() over (partition by r, line order by nth) > 1 as copy,
                len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as words,
                length(regexp_replace(line, '{space}', '', 'g')) as chars,
                length(regexp_replace(line, '[^{SYMBOLS}]', '', 'g')) as symbols
         from sentences where regexp_matches(line, '[^\x20\x09-\x0D]')),
judged as (select r, copy, chars,
       copy
       or (regexp_matches(line, '{SEPARATOR.pattern}') and len(regexp_extract_all(line, '{SEPARATOR.pattern}')) * 4 >= words)
       or (words <= 4 and (regexp_full_match({trimmed}, '(?i){MENU.pattern}') or regexp_full_match({trimmed}, '(?i){LINK.pattern}')))
       or regexp_matches(line, '(?i){BOILERPLATE.pattern}')
       or symbols * 4 >= words
       or (words >= 5 and upper(line) = line and lower(line) <> line)
       or (words >= {OPEN_WORDS} and not ended) as failed
       from held),
lost as (select r, count(*) filter (where copy) as copies, count(*) filter (where failed) as lines,
                coalesce(sum(chars) filter (where failed), 0) as chars from judged group by r),
counts as (select doc_id, len(w) as n_words, length(regexp_replace(text, '{space}', '', 'g')) as word_chars,
                  length(regexp_replace(text, '[^{SYMBOLS}]', '', 'g')) as n_symbols, coalesce(copies, 0) as n_dup_lines,
                  coalesce(covered.n, 0) as n_repeat_words, coalesce(lost.chars, 0) as lost_chars, coalesce(lines, 0) as n_failed_lines
           from d join tokens using (r) left join lost using (r) left join covered using (r)),
based as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words as base_failed from counts)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
       cast(n_dup_lines as bigint) as n_dup_lines, cast(n_repeat_words as bigint) as n_repeat_words, base_failed,
       not base_failed and lost_chars <= {MAX_LOST} * word_chars as kept, cast(lost_chars as bigint) as lost_chars,
       cast(n_failed_lines as bigint) as n_failed_lines
from based"""


SQL = _sql()
