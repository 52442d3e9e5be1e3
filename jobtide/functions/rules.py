"""Ordered keyword rules: the first rule with a whole-word hit names the category."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide import fixed_values as fixed
from jobtide.functions.lexicon import Lexicon
from jobtide.functions.text import as_col, contains_any

RULE_SCHEMA = "rule_order int, category string, keyword_order int, keyword string"
MAX_RULE_ROWS = 20_000


@dataclass(frozen=True)
class RuleSet:
    """Categories in the order they are tried, each with its keywords."""

    rules: tuple[tuple[str, tuple[str, ...]], ...]

    @classmethod
    def of(cls, rules: Iterable[tuple[str, Sequence[str]]]) -> RuleSet:
        return cls(tuple((name, tuple(words)) for name, words in rules))

    @classmethod
    def from_table(cls, table: DataFrame, max_rows: int = MAX_RULE_ROWS) -> RuleSet:
        """Rules from a small table of :data:`RULE_SCHEMA`; refuses one that is not small."""
        rows = table.select("rule_order", "category", "keyword_order", "keyword")
        rows = rows.orderBy("rule_order", "keyword_order").limit(max_rows + 1).collect()
        if len(rows) > max_rows:
            raise ValueError(f"more than {max_rows} keywords: not a rule table")
        grouped: dict[tuple[int, str], list[str]] = {}
        for row in rows:
            grouped.setdefault((row.rule_order, row.category), []).append(row.keyword)
        return cls(tuple((name, tuple(words)) for (_, name), words in grouped.items()))

    @cached_property
    def lexicon(self) -> Lexicon:
        return Lexicon.of(w for _, words in self.rules for w in words)

    @cached_property
    def entries(self) -> dict[str, list[tuple[int, str, int]]]:
        """Keyword to its (rule order, category, keyword order) places, first one first."""
        out: dict[str, list[tuple[int, str, int]]] = {}
        for i, (category, words) in enumerate(self.rules, 1):
            for j, word in enumerate(words, 1):
                if word:
                    out.setdefault(word, []).append((i, category, j))
        return out

    def first_order(self, lowered: Column | str) -> Column:
        """Order number of the first rule that fires, null where none does."""
        best = {}
        for word, places in self.entries.items():
            shorter = self.lexicon.included.get(word, [])
            best[word] = min(p[0] for w in [word, *shorter] for p in self.entries[w])
        if not best:
            return F.lit(None).cast("int")
        table = F.create_map(*[F.lit(x) for kv in best.items() for x in kv])
        hits = self.lexicon.longest_found(lowered)
        return F.array_min(F.transform(hits, lambda w: F.try_element_at(table, w)))

    def first_category(self, lowered: Column | str) -> Column:
        names = F.array(*[F.lit(name) for name, _ in self.rules])
        order = self.first_order(lowered)
        return F.when(order.isNotNull(), F.try_element_at(names, order))

    def trace(self, lowered: Column | str, first_per_rule: bool = False) -> Column:
        """All hits as ``array<struct<rule_order, category, keyword_order, keyword>>``, in order."""
        pairs = []
        for word, places in self.entries.items():
            items = [
                F.struct(
                    F.lit(i).alias("rule_order"),
                    F.lit(category).alias("category"),
                    F.lit(j).alias("keyword_order"),
                    F.lit(word).alias("keyword"),
                )
                for i, category, j in places
            ]
            pairs += [F.lit(word), F.array(*items)]
        table = F.create_map(*pairs)
        found = self.lexicon.found(lowered)
        hits = F.array_sort(F.flatten(F.transform(found, lambda w: F.try_element_at(table, w))))
        if not first_per_rule:
            return hits
        # bound as an element, so that the text is searched once and not for each hit
        return F.transform(
            F.array(hits),
            lambda all_hits: F.filter(
                all_hits,
                lambda h, i: (i == 0) | (F.get(all_hits, i - 1)["rule_order"] != h["rule_order"]),
            ),
        )[0]


def agency_flag(company: Column | str, names: Sequence[str] = fixed.AGENCY_NAMES) -> Column:
    """True where any agency name is part of the company name."""
    return contains_any(F.lower(as_col(company)), names)


def classify(
    company: Column | str,
    description: Column | str,
    rules: RuleSet,
    agencies: Sequence[str] = fixed.AGENCY_NAMES,
    default: str = fixed.DEFAULT_INDUSTRY,
) -> Column:
    """Company name first (not for agencies), then the description, then the default."""
    by_company = rules.first_category(F.lower(as_col(company)))
    by_text = rules.first_category(F.lower(as_col(description)))
    return F.coalesce(
        F.when(~agency_flag(company, agencies), by_company), by_text, F.lit(default)
    )
