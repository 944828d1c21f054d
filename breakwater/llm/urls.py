"""URL filter: all glob rules at once, as one bit-parallel automaton over canonical URLs.

Rules are matched against the host (A-Z in lower case) followed by the path as it is. Globs judge what rules leave, and
see the canonical form: no scheme, user, default port, query or fragment, no dot at the host's end, a path of at least
``/`` without dot segments, and no escape of a character that needs none. Globs are matched whole: ``*`` is any run
without ``/``, ``**`` any run, ``?`` one byte but ``/``, everything else stands for itself, A-Z also for its other case
where the glob says so. Every glob becomes a row of bits, all rows are packed side by side into 64-bit words, and one
shift, two masks and one carry per byte move every one on (Shift-And, with loops on the bits where a wildcard stands).
Rows are packed by rank, so the highest accepting bit is the one that wins.

A null URL and one without ``://`` have an empty host and path; no rule of the defaults fits them, so they are
allowed. URLs of any length are read whole.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import zip_longest
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breakwater.llm.common import lower_ascii

ALLOW, BLOCK = "allow", "block"


class Rule(NamedTuple):
    """``host/path``: fits the host and its subdomains if the path starts like the rule's."""

    verdict: str
    place: str


class Glob(NamedTuple):
    verdict: str
    pattern: str
    any_case: bool = False


# The rules that come first, and the globs that judge what they leave.
RULES = (Rule(BLOCK, "net/"), Rule(ALLOW, "example.net/en/"), Rule(BLOCK, "example.com/de/"), Rule(ALLOW, "org/fr/"))
GLOBS = (
    Glob(BLOCK, "spam-*/**"),
    Glob(BLOCK, "*.spam-*/**"),
    Glob(BLOCK, "*casino*/**"),
    Glob(BLOCK, "*porn*/**"),
    Glob(BLOCK, "ads.*/**"),
    Glob(BLOCK, "**/wp-admin/**", any_case=True),
    Glob(BLOCK, "**/cgi-bin/**", any_case=True),
    Glob(BLOCK, "**.exe", any_case=True),
    Glob(ALLOW, "*/**/robots.txt"),
)
# Ports that schemes have anyway, characters that need no escape.
PORTS = {"http": "80", "https": "443"}
UNRESERVED = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-._~")

# Parameter: globs that a table may have; each costs a few words of masks for every byte value in every task.
MOST_GLOBS = 20_000

_TOKENS = re.compile(r"\*\*|\*|\?|[^*?]", re.S)
_ESCAPE = re.compile("%[0-9A-Fa-f]{2}")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Automaton:
    """Globs in ascending rank; ``best`` gives the highest fitting one of each text, -1 where none fits.

    ``any_case`` says for each glob whether its letters A-Z stand for both cases; without it none do.
    """

    def __init__(self, globs: tuple[str, ...], any_case: tuple[bool, ...] = ()):
        rows = [self._row(glob, either) for glob, either in zip_longest(globs, any_case, fillvalue=False)]
        bits = sum(len(steps) + 1 for steps, _ in rows)
        words = max(1, -(-bits // 64))
        step, loop = np.zeros((256, words * 64), bool), np.zeros((256, words * 64), bool)
        start, accept = np.zeros(words * 64, bool), np.zeros(words * 64, bool)
        self.owner = np.full(words * 64, -1, np.int64)
        at = 0
        for i, (steps, loops) in enumerate(rows):
            start[at], accept[at + len(steps)] = True, True
            self.owner[at + len(steps)] = i
            for k, taken in enumerate(steps):
                step[taken, at + k + 1] = True
            for k, stays in enumerate(loops):
                if stays is not None:
                    loop[stays, at + k] = True
            at += len(steps) + 1
        self.words = words
        self.step, self.loop, self.start, self.accept = (_packed(x) for x in (step, loop, start[None], accept[None]))

    @staticmethod
    def _row(glob: str, any_case: bool) -> tuple[list[np.ndarray], list[np.ndarray | None]]:
        """Bytes that take each step, and bytes that may repeat after so many steps."""
        anything = np.arange(256)
        inside = anything[anything != ord("/")]
        steps: list[np.ndarray] = []
        loops: list[np.ndarray | None] = [None]
        for token in _TOKENS.findall(glob):
            if token == "**":
                loops[-1] = anything
            elif token == "*":
                loops[-1] = inside if loops[-1] is None else loops[-1]
            else:
                cases = {token.lower(), token.upper()} if any_case and token.isascii() else {token}
                own = [np.array(sorted(set(b))) for b in zip(*(case.encode() for case in cases))]
                for taken in [inside] if token == "?" else own:
                    steps.append(taken)
                    loops.append(None)
        return steps, loops

    def best(self, texts: list[bytes]) -> np.ndarray:
        found = np.empty(len(texts), np.int64)
        portion = max(1, 2_000_000 // self.words)
        for begin in range(0, len(texts), portion):
            found[begin : begin + portion] = self._best(texts[begin : begin + portion])
        return found

    def _best(self, texts: list[bytes]) -> np.ndarray:
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(-sizes, kind="stable")
        flat = np.frombuffer(b"".join(texts), np.uint8)
        begins = (np.cumsum(sizes) - sizes)[order]
        left = np.searchsorted(-sizes[order], -np.arange(sizes.max(initial=0)), side="left")
        state = np.repeat(self.start, len(texts), axis=0)
        for place, active in enumerate(left):  # texts longer than ``place``; the state of the others is final
            byte, now = flat[begins[:active] + place], state[:active]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:active] = (moved & self.step[byte]) | (now & self.loop[byte])
        state &= self.accept
        found = np.full(len(texts), -1, np.int64)
        hits = np.flatnonzero(state.any(axis=1))
        if len(hits):
            bits = np.unpackbits(state[hits].view(np.uint8), axis=1, bitorder="little")
            found[order[hits]] = self.owner[bits.shape[1] - 1 - np.argmax(bits[:, ::-1], axis=1)]
        return found


def _packed(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").astype(np.uint64)


def globs_of(table: DataFrame) -> tuple[Glob, ...]:
    """Globs from rows ``verdict, pattern, any_case``; a null case counts, rows without a pattern or verdict do not.

    At most ``MOST_GLOBS``, which every task holds; more raise ``ValueError``, so none is left out.
    """
    rows = table.select("verdict", "pattern", "any_case").distinct().dropna(subset=["verdict", "pattern"]).limit(MOST_GLOBS + 1).collect()
    if len(rows) > MOST_GLOBS:
        raise ValueError(f"more than {MOST_GLOBS} globs")
    return tuple(sorted(Glob(r.verdict, r.pattern, bool(r.any_case)) for r in rows))


def _ranked_globs(globs: tuple[Glob, ...]) -> list[Glob]:
    """By rising rank: short before long, then allow before block."""
    return sorted(globs, key=lambda g: (len(g.pattern), g.verdict == BLOCK, g.pattern, g.any_case))


def _ranked_rules(rules: tuple[Rule, ...]) -> list[tuple[Glob, str]]:
    """Rules as globs, each with its rule, by rising rank."""
    own = sorted(rules, key=lambda r: (len(r.place), r.verdict == BLOCK, r.place))
    return [(Glob(r.verdict, f"{start}{r.place}**"), r.place) for r in own for start in ("", "*.")]


@lru_cache(maxsize=4)
def _automaton(globs: tuple[str, ...], any_case: tuple[bool, ...]) -> Automaton:
    return Automaton(globs, any_case)


def _unescaped(text: str) -> str:
    """Without escapes of characters that need none."""
    return _ESCAPE.sub(lambda m: c if (c := chr(int(m[0][1:], 16))) in UNRESERVED else m[0], text)


def canonical(scheme: str, host: str, path: str) -> str:
    """The form that globs see, of a lower-case scheme, a host and a path; empty where both of these are."""
    if not host and not path:
        return ""
    host = _unescaped(host.rpartition("@")[2]).translate(_LOWER)
    name, colon, port = host.rpartition(":")
    if colon and port in ("", PORTS.get(scheme)):
        host = name
    kept, segments = [], _unescaped(path).split("/")[1:]
    for segment in segments:
        if segment == "..":
            del kept[-1:]
        elif segment != ".":
            kept.append(segment)
    if not segments or segments[-1] in (".", ".."):
        kept.append("")
    return "/".join([host.rstrip("."), *kept])


def canonical_form(scheme: Column, host: Column, path: Column) -> Column:
    @F.arrow_udf("string")
    def form(scheme, host, path):
        import pyarrow as pa

        return pa.array([canonical(*parts) for parts in zip(scheme.to_pylist(), host.to_pylist(), path.to_pylist())], pa.string())

    return form(scheme, host, path)


def scheme_of(url: Column) -> Column:
    """What stands before ``://``, A-Z in lower case; empty without one."""
    return lower_ascii(F.when(F.instr(url, "://") > 0, F.substring_index(url, "://", 1)).otherwise(""))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case, and path; both empty for a null URL or one without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, url.substr(at + 3, F.char_length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.char_length(host) + 1, F.char_length(rest)), "^[^?#]*", 0)
    return lower_ascii(host), path


def fitting(text: Column, globs: list[Glob]) -> Column:
    """The place in ``globs`` of the last one that fits ``text`` whole; -1 if none does or the text is null."""
    wanted, any_case = tuple(g.pattern for g in globs), tuple(g.any_case for g in globs)

    @F.arrow_udf("long")
    def best(batch):
        import pyarrow as pa

        null = batch.is_null().to_numpy(zero_copy_only=False)
        found = _automaton(wanted, any_case).best([t.encode() for t in batch.fill_null("").to_pylist()])
        return pa.array(np.where(null, -1, found))

    return best(text)


def judge(
    pages: DataFrame, url: str = "url", rules: tuple[Rule, ...] = RULES, globs: tuple[Glob, ...] = GLOBS
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (null where none fits) and ``verdict``.

    Columns of those names that ``pages`` has already are replaced; repeated rows are judged alike. Globs of a table
    come from :func:`globs_of`.
    """
    ruled, own = _ranked_rules(rules), _ranked_globs(globs)
    host, path = host_and_path(F.col(f"`{url}`"))
    kept = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    parts = pages.select(*kept, host.alias("host"), path.alias("path"), scheme_of(F.col(f"`{url}`")).alias("_scheme"))
    parts = parts.withColumn("_canonical", canonical_form(F.coalesce("_scheme", F.lit("")), F.col("host"), F.col("path")))
    found = parts.select(
        "*", fitting(F.concat("host", "path"), [glob for glob, _ in ruled]).alias("_rule"), fitting(F.col("_canonical"), own).alias("_glob")
    )
    # A first place for none keeps the arrays typed where there are no rules or globs.
    places, of_rules, of_globs = (
        F.array(F.lit(None).cast("string"), *map(F.lit, values))
        for values in ([place for _, place in ruled], [glob.verdict for glob, _ in ruled], [glob.verdict for glob in own])
    )
    return found.select(
        *[F.col(f"`{c}`") for c in parts.columns if c not in ("_scheme", "_canonical")],
        F.get(places, F.col("_rule") + 1).alias("rule"),
        F.coalesce(F.get(of_rules, F.col("_rule") + 1), F.get(of_globs, F.col("_glob") + 1), F.lit(ALLOW)).alias("verdict"),
    )


def verdicts(pages: DataFrame) -> DataFrame:
    """Per page its host, path, rule and verdict; other columns are not read."""
    return judge(pages.select("page_id", "url")).drop("url")


def _plainly(text: str) -> str:
    """SQL for a text without escapes of characters that need none."""
    return (
        rf"array_to_string([case when regexp_full_match(t, '(?i)%(2D|2E|5F|7E|3[0-9]|[46][1-9A-F]|[57][0-9A])') "
        rf"then chr(cast('0x' || substr(t, 2) as int)) else t end for t in regexp_extract_all({text}, '%[0-9A-Fa-f]{{2}}|[^%]+|%')], '')"
    )


#: The same verdicts for SQL: rules by suffix and prefix tests, globs as regular expressions over the canonical form.
SQL = rf"""
with rests as (
    select page_id, case when position('://' in url) > 0 then substr(url, position('://' in url) + 3) else '' end as rest,
           case when position('://' in url) > 0 then substr(url, 1, position('://' in url) - 1) else '' end as raw_scheme
    from pages),
parts as (
    select page_id, rest, raw_scheme, regexp_extract(rest, '^[^/?#]*') as raw_host from rests),
places as (
    select page_id, translate(raw_scheme, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as scheme,
           translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
           regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') as path
    from parts),
plain as (
    select *, translate({_plainly("regexp_replace(host, '(?s)^.*@', '')")}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as bare,
           string_split({_plainly("path")}, '/') as segments
    from places),
canonical as (
    select * exclude (bare, segments),
           case when host = '' and path = '' then '' else regexp_replace(regexp_replace(bare, case scheme when 'http' then ':(80)?$'
                when 'https' then ':(443)?$' else ':$' end, ''), '\.+$', '') end as seen_host,
           case when host = '' and path = '' then '' else list_reduce(segments, lambda a, x: case when x = '..' then
                regexp_replace(a, '(?s)/[^/]*$', '') when x = '.' then a else a || '/' || x end)
                || case when len(segments) = 1 or segments[-1] in ('.', '..') then '/' else '' end end as seen
    from plain),
ruled as (
    select *, case
        when (host = 'example.net' or ends_with(host, '.example.net')) and starts_with(path, '/en/') then 'example.net/en/'
        when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/de/') then 'example.com/de/'
        when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
        when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/') then 'net/' end as rule
    from canonical)
select page_id, host, path, rule, case
    when rule is not null then case when rule in ('net/', 'example.com/de/') then 'block' else 'allow' end
    when seen like '%/robots.txt' and seen <> '/robots.txt' then 'allow'
    when seen ilike '%/wp-admin/%' or seen ilike '%/cgi-bin/%' then 'block'
    when regexp_matches(seen_host, '(^|\.)spam-') or seen_host like '%casino%' or seen_host like '%porn%'
         or starts_with(seen_host, 'ads.') then 'block'
    when seen_host || seen ilike '%.exe' then 'block'
    else 'allow' end as verdict
from ruled
"""
