r"""From the rule author's regex dialect (Python's ``re``) to Spark expressions.

A rule set holds many patterns of the shape ``\b(word|word|two words)\b``. Scanning a
text once per pattern costs one regex pass each. A word between two boundaries matches
exactly when it equals one whole run of word characters, so such patterns are answered
from the set of words of the text, split once and shared by every pattern. Only
alternatives that are not plain words stay regexes, behind a cheap necessary condition.
"""

from __future__ import annotations

import re
import re._parser as re_parser  # the dialect's own parse tree, to read facts off a pattern
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from marginalia.functions.text import WHITESPACE_CLASS, WORD_CLASS

_WORD = f"[{WORD_CLASS}]"
# Case-insensitive, Unicode case folding, "\n" as the only line end.
JAVA_FLAGS = "(?iud)"

# Python shorthand -> Java, outside and inside a character class.
_OUTSIDE = {
    "b": f"(?:(?<={_WORD})(?!{_WORD})|(?<!{_WORD})(?={_WORD}))",
    "B": f"(?:(?<={_WORD})(?={_WORD})|(?<!{_WORD})(?!{_WORD}))",
    "w": _WORD,
    "W": f"[^{WORD_CLASS}]",
    "s": f"[{WHITESPACE_CLASS}]",
    "S": f"[^{WHITESPACE_CLASS}]",
    "d": r"\p{Nd}",
    "D": r"\P{Nd}",
    "v": r"\x0b",
    "Z": r"\z",
}
_INSIDE = {
    "b": r"\x08",
    "v": r"\x0b",
    "w": WORD_CLASS,
    "W": f"[^{WORD_CLASS}]",
    "s": WHITESPACE_CLASS,
    "S": f"[^{WHITESPACE_CLASS}]",
    "d": r"\p{Nd}",
    "D": r"\P{Nd}",
}
_PIECE = re.compile(
    r"\\U(?P<wide>[0-9A-Fa-f]{8})|\\(?P<esc>.)|\(\?P<(?P<group>\w+)>|\(\?P=(?P<back>\w+)\)"
    r"|\{,(?P<most>\d+)\}|(?P<char>.)",
    re.DOTALL,
)
_ALTERNATION = re.compile(r"\\b\((?:\?:)?([^()\[\]]+)\)\\b")
# Words in a group between boundaries: followed by \b, a space, or at least one \s or \W.
_LEADING_WORDS = re.compile(r"\\b\((\w+(?:\|\w+)*)\)(?=\\b|(?:\\[sW]| )(?![*?{]))", re.ASCII)
_PLAIN_WORD = re.compile(r"[A-Za-z0-9_]+")
_PHRASE = re.compile(r"([A-Za-z0-9_]+)(?:[ ',%/&-]+[A-Za-z0-9_]+)+")
# Letters outside ASCII that a case-insensitive ASCII pattern also accepts.
_FOLDED_FROM, _FOLDED_TO = "İıſ\u212a", "iisk"


def to_java(pattern: str) -> str:
    """Rewrite a Python regex so that Java finds the same texts."""
    re.compile(pattern, re.IGNORECASE)  # reject what the rule author's dialect rejects
    out: list[str] = []
    in_class = class_start = False
    for piece in _PIECE.finditer(pattern):
        kind, value = piece.lastgroup, piece.group(piece.lastgroup)
        starts, class_start = class_start, False
        if kind == "wide":
            out.append(f"\\x{{{value}}}")
        elif kind == "esc":
            out.append((_INSIDE if in_class else _OUTSIDE).get(value, "\\" + value))
        elif in_class:
            if kind != "char":
                # group-like text inside a class is just characters
                out.append(re.sub(r"([\[&])", r"\\\1", piece.group()))
            elif value == "]" and not starts:
                in_class = False
                out.append("]")
            elif value == "^" and starts:
                class_start = True  # a "]" right after "[^" is still literal
                out.append("^")
            else:
                out.append("\\" + value if value in "[]&~" else value)
        elif kind == "group":
            out.append(f"(?<{_java_group(value)}>")
        elif kind == "back":
            out.append(f"\\k<{_java_group(value)}>")
        elif kind == "most":
            out.append(f"{{0,{value}}}")
        else:
            if value == "[":
                in_class = class_start = True
            out.append(value)
    return JAVA_FLAGS + "".join(out)


def _java_group(name: str) -> str:
    return "g" + "".join(c if c.isascii() and c.isalnum() else f"x{ord(c):x}" for c in name)


@dataclass(frozen=True)
class Signal:
    """One pattern, split by how its alternatives can be answered."""

    pattern: str
    words: tuple[str, ...] = ()
    phrases: tuple[tuple[str, str], ...] = ()  # (first word, phrase)
    rest: str | None = None  # Python regex still to be searched for
    rest_needs: tuple[str, ...] = ()  # one of these must occur for `rest` (see necessary_parts)
    rest_words: tuple[str, ...] = ()  # or rather, one of these as a whole word

    @property
    def vocabulary(self) -> set[str]:
        return {*self.words, *(first for first, _ in self.phrases), *self.rest_words}


def split_signal(pattern: str) -> Signal:
    shape = _ALTERNATION.fullmatch(pattern)
    if not shape or r"\|" in shape[1]:
        return Signal(
            pattern, rest=pattern, rest_needs=necessary_parts(pattern), rest_words=_leading_words(pattern)
        )
    words, phrases, rest = [], [], []
    for option in shape[1].split("|"):
        phrase = _PHRASE.fullmatch(option)
        if _PLAIN_WORD.fullmatch(option):
            words.append(option.lower())
        elif phrase:
            phrases.append((phrase[1].lower(), option))
        else:
            rest.append(option)
    left = rf"\b({'|'.join(rest)})\b" if rest else None
    return Signal(
        pattern,
        tuple(dict.fromkeys(words)),
        tuple(phrases),
        left,
        necessary_parts(left) if left else (),
    )


def _leading_words(pattern: str) -> tuple[str, ...]:
    """Whole words, one of which starts every match; empty where that is not certain."""
    lead = _LEADING_WORDS.match(pattern)
    if not lead or "|" in re.sub(r"\([^()]*\)", "", pattern):
        return ()
    return tuple(dict.fromkeys(lead[1].lower().split("|")))


def necessary_parts(pattern: str) -> tuple[str, ...]:
    """Parts of which every match contains at least one; empty where nothing is certain.

    A part is a lower-case ASCII substring, or "x-y" (three characters, x and y caseless
    and outside ASCII) for some character between x and y. Finding a substring is far cheaper than a
    regex scan, and most texts hold none of them.
    """
    return _necessary(re_parser.parse(pattern, re.IGNORECASE))


def _necessary(tree: Iterable) -> tuple[str, ...]:
    candidates: list[tuple[str, ...]] = []
    run = ""
    for op, value in [*tree, (None, None)]:
        if op is re_parser.LITERAL and value < 128:
            run += chr(value).lower()
            continue
        candidates.append((run,) if run else ())
        run = ""
        if op is re_parser.SUBPATTERN:
            candidates.append(_necessary(value[-1]))
        elif op in (re_parser.MAX_REPEAT, re_parser.MIN_REPEAT) and value[0] > 0:
            candidates.append(_necessary(value[2]))
        elif op is re_parser.BRANCH:
            branches = [_necessary(branch) for branch in value[1]]
            candidates.append(tuple(p for b in branches for p in b) if all(branches) else ())
        elif op is re_parser.IN:
            candidates.append(_span(value))
    certain = [c for c in candidates if c]
    return max(certain, key=lambda parts: (min(map(len, parts)), -len(parts)), default=())


def _span(members: Iterable) -> tuple[str, ...]:
    """The range around a class of single, caseless, non-ASCII characters."""
    members = list(members)
    if any(op is not re_parser.LITERAL or value < 128 for op, value in members):
        return ()
    chars = sorted(chr(value) for _, value in members)
    if any(c.lower() != c or c.upper() != c for c in chars):
        return ()
    return (f"{chars[0]}-{chars[-1]}",)


def _may_match(parts: tuple[str, ...], folded: Column) -> Column:
    possible = F.lit(False)
    for part in parts:
        is_range = len(part) == 3 and part[1] == "-" and not part.isascii()
        possible = possible | (folded.rlike(f"[{part}]") if is_range else folded.contains(part))
    return possible


def fold_case(text: Column) -> Column:
    """Lower case, with the letters that fold to ASCII i, s and k mapped there first."""
    exotic = F.lit(False)
    for letter in _FOLDED_FROM:
        exotic = exotic | text.contains(letter)
    return F.lower(F.when(exotic, F.translate(text, _FOLDED_FROM, _FOLDED_TO)).otherwise(text))


def known_words(folded: Column, vocabulary: set[str]) -> Column:
    """The distinct words of a case-folded text that some pattern asks for."""
    if not vocabulary:
        return F.array().cast("array<string>")
    words = F.split(folded, f"[^{WORD_CLASS}]+")
    return F.array_intersect(words, _word_list(sorted(vocabulary)))


def _word_list(words: Iterable[str]) -> Column:
    """A constant array of words (the split is folded away at planning)."""
    return F.split(F.lit(" ".join(words)), " ")


def signal_found(signal: Signal, text: Column, folded: Column, words: Column) -> Column:
    """True where the pattern occurs anywhere in the text."""
    options = []
    if signal.words:
        options.append(F.arrays_overlap(words, _word_list(signal.words)))
    if signal.phrases:
        firsts = dict.fromkeys(first for first, _ in signal.phrases)
        phrase_rx = r"\b(" + "|".join(p for _, p in signal.phrases) + r")\b"
        options.append(
            F.arrays_overlap(words, _word_list(firsts))
            & text.rlike(to_java(phrase_rx))
        )
    if signal.rest:
        found = text.rlike(to_java(signal.rest))
        if signal.rest_words:
            found = F.arrays_overlap(words, _word_list(signal.rest_words)) & found
        elif signal.rest_needs:
            found = _may_match(signal.rest_needs, folded) & found
        options.append(found)
    result = options[0]
    for option in options[1:]:
        result = result | option
    return result


def check_patterns(spark: SparkSession, patterns: list[str]) -> None:
    """Fail before the job starts if a pattern is invalid or the engine cannot compile it."""
    translated = {}
    for pattern in patterns:
        try:
            translated[pattern] = to_java(pattern)
        except re.error as error:
            raise ValueError(f"not a valid pattern: {pattern!r} ({error})") from error

    def compiles(*java: str) -> bool:
        text = F.concat(F.lit(""), F.col("id"))
        try:
            spark.range(1).select(*[text.rlike(j).alias(f"p{i}") for i, j in enumerate(java)]).collect()
        except Exception:  # noqa: BLE001 - any engine error means "cannot compile"
            return False
        return True

    if translated and not compiles(*translated.values()):
        refused = [p for p, java in translated.items() if not compiles(java)]
        raise ValueError(f"pattern not supported by the engine: {refused}")
