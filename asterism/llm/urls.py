"""URL filters: a bit-parallel automaton that runs all glob rules at once over each canonical URL."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: URLs simulated side by side, and the cells (URLs x characters) of one such block.
BLOCK_ROWS, BLOCK_CELLS = 8192, 1 << 22

RESULT = "rule string, verdict string, canonical string"


@dataclass(frozen=True)
class Rule:
    """A host with all its subdomains, and the start of the path."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = [Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
         Rule("block", "net", "/es/"), Rule("block", "net", "/fr/")]
#: Words of hosts, and globs over host and path, blocked where no rule fits.
#: ``*`` stops at a slash, ``**`` doesn't.
HOST_WORDS = ["casino", "pills", "poker", "spam", "torrent", "warez", "xxx"]
PATH_GLOBS = ["**/ads/**", "**/banner/**", "**/cgi-bin/**", "**/phpmyadmin/**", "**/wp-admin/**", "**/wp-login.php", "**.apk", "**.exe"]
GLOBS = [f"*{w}*{end}" for w in HOST_WORDS for end in ("", "/**")] + PATH_GLOBS

#: What :func:`canonical` takes for a scheme's own port.
PORTS = {"http": "80", "https": "443", "ftp": "21"}


def canonical(url: str | None) -> str:
    """Host and path of a URL in one spelling; empty without ``://``.

    Without user, the scheme's own port, final dots of the host, query and fragment;
    A-Z of the host in lower case; escapes of letters, digits and ``-._~`` decoded, others
    in upper case (broken ones stay); dot segments resolved; an empty path is ``/``.
    """
    scheme, found, rest = (url or "").partition("://")
    if not found:
        return ""
    authority, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
    host, _, port = authority.rpartition("@")[2].partition(":") if "[" not in authority else (
        authority.rpartition("@")[2].partition("]")[0] + "]", "", authority.rpartition("]")[2].lstrip(":"))
    host = "".join(c.lower() if c.isascii() else c for c in host).rstrip(".")
    port = "" if port in ("", PORTS.get(scheme.lower())) else f":{port}"
    return host + port + _resolved(re.sub("%([0-9A-Fa-f]{2})", _unescaped, path))


def _unescaped(escape: re.Match) -> str:
    char = chr(int(escape[1], 16))
    return char if char.isascii() and (char.isalnum() or char in "-._~") else escape[0].upper()


def _resolved(path: str) -> str:
    """The path without ``.`` and ``..`` segments."""
    out: list[str] = []
    segments = path.split("/")[1:]
    for segment in segments:
        if segment == "..":
            del out[-1:]
        elif segment != ".":
            out.append(segment)
    if segments[-1:] in (["."], [".."]):
        out.append("")
    return "/" + "/".join(out)


class GlobAutomaton:
    """Glob patterns packed into 64-bit words for Shift-And.

    A pattern takes one bit per literal character. ``D`` holds a bit for each prefix
    that has just been matched; reading a character shifts it and keeps what the
    character allows. A star before or after a literal is a loop on the bit before it,
    kept while the character read is one that the star covers. A leading star is a
    loop on the pattern's start bit. All patterns and a block of strings advance in
    one step of a few array operations.
    """

    def __init__(self, patterns: Sequence[str]):
        bits: list[tuple[int | None, int]] = []  # (literal byte or None for a start, loop: 0, 1 = not '/', 2 = any)
        self.final: list[int] = []
        starts = []
        for pattern in patterns:
            raw, i = pattern.encode(), 0
            starts.append(len(bits))
            bits.append((None, 0))
            while i < len(raw):
                if raw[i:i + 1] == b"*":
                    stop = i
                    while raw[stop:stop + 1] == b"*":
                        stop += 1
                    bits[-1] = (bits[-1][0], max(bits[-1][1], 2 if stop - i > 1 else 1))
                    i = stop
                else:
                    bits.append((raw[i], 0))
                    i += 1
            self.final.append(len(bits) - 1)
        self.words = (len(bits) + 63) // 64
        self.start = self._mask(starts)
        self.allows = np.zeros((256, self.words), np.uint64)
        self.loops = np.zeros((256, self.words), np.uint64)
        for at, (literal, loop) in enumerate(bits):
            word, bit = at // 64, np.uint64(1 << at % 64)
            if literal is not None:
                self.allows[literal, word] |= bit
            if loop:
                self.loops[:, word] |= bit
                if loop == 1:
                    self.loops[ord("/"), word] &= ~bit

    def _mask(self, bits: Sequence[int]) -> np.ndarray:
        out = np.zeros(self.words, np.uint64)
        for at in bits:
            out[at // 64] |= np.uint64(1 << at % 64)
        return out

    def match(self, texts: Sequence[bytes]) -> np.ndarray:
        """Boolean (texts x patterns): which patterns match which whole text."""
        out = np.zeros((len(texts), len(self.final)), bool)
        order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
        at = 0
        while at < len(order):  # strings of like length together, in blocks of bounded size
            rows = min(BLOCK_ROWS, max(1, BLOCK_CELLS // max(1, len(texts[order[min(at + BLOCK_ROWS, len(order)) - 1]]))))
            block = order[at:at + rows]
            out[block] = self._run([texts[i] for i in block])
            at += rows
        return out

    def _run(self, texts: list[bytes]) -> np.ndarray:
        lengths = np.array([len(t) for t in texts])
        flat = np.frombuffer(b"".join(texts), np.uint8)
        ends = lengths.cumsum()
        state = np.tile(self.start, (len(texts), 1))
        done = np.empty_like(state)
        done[lengths == 0] = state[lengths == 0]
        live = np.nonzero(lengths)[0]
        offsets = (ends - lengths)[live]
        state, lengths = state[live], lengths[live]
        for step in range(int(lengths.max(initial=0))):
            char = flat[offsets + step]
            shifted = state << np.uint64(1)
            shifted[:, 1:] |= state[:, :-1] >> np.uint64(63)  # carry into the next word
            state = (shifted & self.allows[char]) | (state & self.loops[char])
            ended = lengths == step + 1
            if ended.any():
                done[live[ended]] = state[ended]
                keep = ~ended
                state, offsets, lengths, live = state[keep], offsets[keep], lengths[keep], live[keep]
        return np.stack([(done[:, f // 64] >> np.uint64(f % 64)) & np.uint64(1) for f in self.final], 1).astype(bool)


class UrlJudge:
    """Rules and globs in one automaton; the longest rule that fits decides, else the globs.

    Rules are held against host and path as they stand, globs against the canonical form.
    """

    def __init__(self, rules: Sequence[Rule], globs: Sequence[str]):
        self.rules, patterns = list(rules), []
        for rule in self.rules:
            patterns += [f"{rule.host}{rule.path}**", f"*.{rule.host}{rule.path}**"]
        self.automaton = GlobAutomaton([*patterns, *globs])
        # longest first; of equal length the one listed first
        self.order = sorted(range(len(self.rules)), key=lambda i: (-len(self.rules[i].text), i))

    def judge(self, urls: Sequence[str], forms: Sequence[str] | None = None) -> pd.DataFrame:
        """Rule and verdict of each host and path; ``forms`` are their canonical forms, if they differ."""
        hits = self.automaton.match([u.encode() for u in urls])
        blocked = hits[:, 2 * len(self.rules):].any(axis=1)
        respelt = [i for i, form in enumerate(forms or []) if form != urls[i]]
        if respelt:
            blocked[respelt] = self.automaton.match([forms[i].encode() for i in respelt])[:, 2 * len(self.rules):].any(axis=1)
        rule = np.full(len(urls), None, object)
        verdict = np.where(blocked, "block", "allow").astype(object)
        free = np.ones(len(urls), bool)
        for i in self.order:
            fits = free & (hits[:, 2 * i] | hits[:, 2 * i + 1])
            rule[fits], verdict[fits] = self.rules[i].text, self.rules[i].verdict
            free &= ~fits
        return pd.DataFrame({"rule": rule, "verdict": verdict})


def host_of(url: Column) -> Column:
    """From the first ``://`` to the next of ``/?#``, A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, globs: Sequence[str] = GLOBS,
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, canonical`` for every row.

    A rule fits its host and all subdomains where the path starts with the rule's;
    the longest decides (of equal length, the first listed). Where none fits, a URL
    whose canonical form (:func:`canonical`) matches a glob is blocked, else allowed.
    Rules and globs are one automaton, run in blocks of URLs of like length; one
    pass, no shuffle.

    Defined cases: a null URL, or one without ``://``, has an empty host, path and
    canonical form, fits no rule and is allowed; rows that repeat are judged alike; a null id stays null; an
    empty table gives an empty result; other columns are ignored.
    """
    rules, globs = list(rules), list(globs)

    @F.pandas_udf(RESULT)
    def judge(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        by = UrlJudge(rules, globs)
        for places, urls in batches:
            forms = [canonical(u) for u in urls]
            yield by.judge(places.tolist(), forms).assign(canonical=forms)

    url = F.col(url_col)
    parts = pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url"), host_of(url).alias("host"),
                         path_of(url).alias("path"))
    judged = parts.withColumn("judged", judge(F.concat("host", "path"), "url"))
    return judged.select("page_id", "host", "path", "judged.rule", "judged.verdict", "judged.canonical")
