"""URL rules looked up by their rarest word.

A rule is a pattern over ``host + path``:

* ``||`` at its start: the start of the host, or any dot in it (the host and its subdomains);
* ``^``: an end of the URL or a character other than an ASCII letter or digit;
* ``*``: any characters; everything else stands for itself. A pattern need not reach either end.

Words are runs of ASCII letters and digits. Where a rule's words are closed on both
sides, every URL that it fits has them among its own. The rule is filed under the one
of them that the fewest URLs hold, counted over all given URLs; a URL fetches the rules filed under its
words and runs only their regular expressions. A rule without a closed word is
tried on every URL.

``listed`` rules (a host with a path) take precedence, the longest first; otherwise a
URL is blocked if a blocking pattern fits and no allowing one does. NULL or a text without
``://`` has an empty host and path, which no listed rule fits; it is allowed. An empty table gives
no rows, repeated rows are judged alike, and other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WORD = re.compile(r"[A-Za-z0-9]+")
_PARTS = re.compile(r"([^/?#]*)([^?#]*)")
_UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


@dataclass(frozen=True)
class Rule:
    """``listed`` rules match case as it stands; the others do not."""

    text: str
    pattern: str
    allow: bool
    listed: bool = False

    def regex(self) -> re.Pattern:
        body = self.pattern.removeprefix("||")
        source = "".join(
            {"*": ".*", "^": r"(?:^|$|[^A-Za-z0-9])"}.get(c, re.escape(c)) for c in body
        )
        if body != self.pattern:
            source = r"^(?:[^/]*\.)?" + source
        return re.compile(source, re.DOTALL if self.listed else re.DOTALL | re.IGNORECASE | re.ASCII)

    def closed_words(self) -> set[str]:
        """Words between two characters that cannot belong to a longer word."""
        body = self.pattern.removeprefix("||")
        open_start = body == self.pattern
        return {
            m[0].translate(_UPPER)
            for m in _WORD.finditer(body)
            if not (open_start if m.start() == 0 else body[m.start() - 1] == "*")
            and not (m.end() == len(body) or body[m.end()] == "*")
        }


def listed(host: str, path: str, allow: bool) -> Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""
    return Rule(host + path, f"||{host}{path}*", allow, listed=True)


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path."""
    _, found, rest = (url or "").partition("://")
    host, path = _PARTS.match(rest).groups() if found else ("", "")
    return host.translate(_UPPER), path


def words_of(host: str, path: str) -> set[str]:
    return {w.translate(_UPPER) for w in _WORD.findall(f"{host}{path}")}


def word_counts(urls: DataFrame, words: set[str], url: str = "url") -> dict[str, int]:
    """How many URLs hold each of ``words``; the answer is as long as the rules are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("url").to_pylist():
                found.update(words & words_of(*split_url(text)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
            names=["word", "n"],
        )

    counts = urls.select(F.col(url).alias("url")).mapInArrow(count, "word string, n long")
    return {r["word"]: r["n"] for r in counts.groupBy("word").agg(F.sum("n").alias("n")).collect()}


@dataclass(frozen=True)
class Index:
    """Rules by their rarest closed word, and those that have none."""

    by_word: dict[str, list[Rule]]
    anywhere: list[Rule]

    @classmethod
    def build(cls, rules: list[Rule], counts: dict[str, int]) -> Index:
        by_word: dict[str, list[Rule]] = {}
        anywhere = []
        for rule in rules:
            words = rule.closed_words()
            if words:
                rarest = min(words, key=lambda w: (counts.get(w, 0), -len(w), w))
                by_word.setdefault(rarest, []).append(rule)
            else:
                anywhere.append(rule)
        return cls(by_word, anywhere)

    def matcher(self) -> Callable[[str, str], tuple[str | None, bool, str | None]]:
        """(host, path) to the listed rule, whether to allow, and the pattern that decided."""
        regex = {r: r.regex() for rules in (*self.by_word.values(), self.anywhere) for r in rules}

        def judge(host: str, path: str) -> tuple[str | None, bool, str | None]:
            target = host + path
            candidates = [r for w in words_of(host, path) for r in self.by_word.get(w, ())]
            fits = [r for r in (*candidates, *self.anywhere) if regex[r].search(target)]
            best = max((r for r in fits if r.listed), key=lambda r: (len(r.text), not r.allow, r.text), default=None)
            if best:
                return best.text, best.allow, best.text
            patterns = sorted((r for r in fits if not r.listed), key=lambda r: (not r.allow, r.text))
            # Allowing patterns sort last, and any of them outweighs the blocking ones.
            if not patterns:
                return None, True, None
            allowing = [r for r in patterns if r.allow]
            chosen = allowing[0] if allowing else patterns[0]
            return None, chosen.allow, chosen.text

        return judge


def judge_urls(pages: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url") -> DataFrame:
    """key, host, path, rule (the listed rule), verdict, decided_by (rule or pattern)."""
    words = set().union(*(r.closed_words() for r in rules)) if rules else set()
    index = Index.build(rules, word_counts(pages, words, url))
    key_type = pages.schema[key].dataType.simpleString()
    columns = ["host", "path", "rule", "verdict", "decided_by"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = index.matcher()
        for batch in batches:
            rows = []
            for text in batch.column("url").to_pylist():
                host, path = split_url(text)
                rule, allow, by = judge(host, path)
                rows.append((host, path, rule, "allow" if allow else "block", by))
            values = zip(*rows) if rows else [()] * len(columns)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *(pa.array(v, pa.string()) for v in values)], names=["key", *columns]
            )

    out = pages.select(F.col(key).alias("key"), F.col(url).alias("url")).mapInArrow(
        run, f"key {key_type}, " + ", ".join(f"{c} string" for c in columns)
    )
    return out.withColumnRenamed("key", key)


# Hosts and paths that are unwanted in training data, as whole words.
UNWANTED_WORDS = [
    "adult", "porn", "xxx", "sex", "escort", "camgirls",
    "casino", "poker", "betting", "bets", "jackpot", "slots",
    "pills", "viagra", "cialis", "pharma",
    "spam", "phishing", "malware", "warez", "torrent", "keygen",
    "ads", "adserver", "doubleclick", "popunder", "clickbait",
]
UNWANTED = [Rule(f"^{word}^", f"^{word}^", allow=False) for word in UNWANTED_WORDS]
