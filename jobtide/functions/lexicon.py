"""Whole-word dictionary search in one pass over the text.

Testing each term with its own regular expression costs one scan of the text per term.  Here the
dictionary becomes a single prefix-tree pattern inside a look-ahead, so terms that overlap
(``text classification`` and ``classification``) are all seen and the cost hardly depends on the
number of terms.  Of several terms that start at the same character only the longest is reported;
the shorter ones it includes are known from the dictionary alone and added by a lookup.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobtide.functions.text import WORD, as_col


def is_word_char(ch: str) -> bool:
    return ch.isalnum() or ch == "_"


def _escape(ch: str) -> str:
    return ch if is_word_char(ch) else "\\" + ch if ord(ch) < 128 else ch


def _edge_after(term: str) -> str:
    return f"(?![{WORD}])" if is_word_char(term[-1]) else f"(?=[{WORD}])"


def _tree_pattern(terms: list[str], depth: int = 0) -> str:
    """Pattern for terms that agree on their first ``depth`` characters, longest first."""
    branches: dict[str, list[str]] = {}
    stop = ""
    for term in terms:
        if len(term) == depth:
            stop = _edge_after(term)
        else:
            branches.setdefault(term[depth], []).append(term)
    options = [_escape(ch) + _tree_pattern(sub, depth + 1) for ch, sub in branches.items()]
    if stop:
        options.append(stop)
    return options[0] if len(options) == 1 else "(?:" + "|".join(options) + ")"


@dataclass(frozen=True)
class Lexicon:
    """A set of terms, searched as whole words in lower-cased text."""

    terms: tuple[str, ...] = field()

    @classmethod
    def of(cls, terms: Iterable[str]) -> Lexicon:
        return cls(tuple(dict.fromkeys(t for t in terms if t)))

    @cached_property
    def included(self) -> dict[str, list[str]]:
        """For each term, the shorter terms that also match wherever it matches at its start."""
        known = set(self.terms)
        out: dict[str, list[str]] = {}
        for term in self.terms:
            inner = [
                term[:n]
                for n in range(1, len(term))
                if term[:n] in known and is_word_char(term[n - 1]) != is_word_char(term[n])
            ]
            if inner:
                out[term] = inner
        return out

    def patterns(self) -> list[str]:
        """One pattern for terms that begin with a word character, one for the others."""
        wordy = sorted(t for t in self.terms if is_word_char(t[0]))
        other = sorted(t for t in self.terms if not is_word_char(t[0]))
        out = []
        if wordy:
            out.append(f"(?<![{WORD}])(?=({_tree_pattern(wordy)}))")
        if other:
            out.append(f"(?<=[{WORD}])(?=({_tree_pattern(other)}))")
        return out

    def longest_found(self, lowered: Column | str) -> Column:
        """Distinct terms met, without the shorter ones that share their start."""
        text = F.coalesce(as_col(lowered), F.lit(""))
        hits = [F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in self.patterns()]
        if not hits:
            return F.array().cast("array<string>")
        return F.array_distinct(hits[0] if len(hits) == 1 else F.concat(*hits))

    def found(self, lowered: Column | str) -> Column:
        """Sorted distinct terms that occur in the text."""
        hits = self.longest_found(lowered)
        if self.included:
            pairs = [
                x
                for term, inner in self.included.items()
                for x in (F.lit(term), F.array(*[F.lit(i) for i in inner]))
            ]
            more = F.create_map(*pairs)
            none = F.array().cast("array<string>")

            def with_shorter(met: Column) -> Column:
                extra = F.transform(met, lambda t: F.coalesce(F.try_element_at(more, t), none))
                return F.array_distinct(F.concat(met, F.flatten(extra)))

            # bound as an element, so that the text is searched once
            hits = F.transform(F.array(hits), with_shorter)[0]
        return F.array_sort(hits)

    def occurs(self, lowered: Column | str) -> Column:
        """True where any term occurs."""
        text = F.coalesce(as_col(lowered), F.lit(""))
        out = F.lit(False)
        for p in self.patterns():
            out = out | text.rlike(p)
        return out
