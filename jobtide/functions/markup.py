"""Elements of HTML pages as Spark SQL expressions.

The functions take and return SQL text: a page needs some hundred nested calls, which are parsed at once
instead of being put together one by one from Python.

A page is cut at opening tags by regular expressions, and an element ends where its own tag is closed
as often as it was opened, so nested elements of one name are read right.  An element that is never
closed reaches to the end of what holds it in the path.  Comments, scripts, styles and templates are
taken out first.  Attribute values may be quoted or bare; a ``>`` inside a quoted value hides the
attributes after it from tests.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from html.entities import html5, name2codepoint

from jobtide.functions.text import SPACE

_ATTRIBUTES = r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+"
_REST = rf"(?:{_ATTRIBUTES}|[^>]*+)>"
# What all choices begin with stands before them, so that other places of a text are passed over quickly.
_TAG = rf"<(?:/?[a-zA-Z]{_REST}|[!?/][^>]*+>)"
_HIDDEN = r"(?is)<(?:!--(?:.*?-->|.*\z)|(script|style|template)(?=[\s/>])[^>]*+>.*?(?:</\1[^>]*+>|\z))"
# Elements without an end tag.
_VOID = "area|base|br|col|embed|hr|img|input|link|meta|param|source|track|wbr"
_ENTITY = r"&(?:#[0-9xX]|[a-zA-Z])"
# Entities that count without a semicolon, longest first.
_LEGACY = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
# One literal, as a map of single literals makes plans slow to build.
_NAMES = "\n".join(f"{n}\t{chr(p)}" for n, p in {**name2codepoint, "apos": 39}.items())
_OPENING = rf"^<[a-zA-Z]{_REST}"
_numbers = itertools.count()


def literal(value: str) -> str:
    """A text as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _lambda(use: Callable[..., str], *names: str) -> str:
    own = [f"{n}_{next(_numbers)}" for n in names]
    listed = own[0] if len(own) == 1 else f"({', '.join(own)})"
    return f"{listed} -> {use(*own)}"


@dataclass(frozen=True)
class Tag:
    """An opening tag: its name (``''``: any) and a test of one attribute.

    ``how``: ``is`` the value, ``begins`` with it, ``holds`` it, has it as a ``word``, or the tag
    ``has`` or ``lacks`` the attribute.  ``fold`` ignores the case of the value.
    """

    name: str = ""
    attr: str = ""
    value: str = ""
    how: str = "is"
    fold: bool = False

    def pattern(self) -> str:
        name = rf"(?i:{self.name})" if self.name else r"[a-zA-Z][^\s/>]*+"
        return rf"<{name}(?=[\s/>]){self._test()}{_REST}"

    def _test(self) -> str:
        if not self.attr:
            return ""
        start = rf"[^>]*?[\s\"'](?i:{self.attr})"
        if self.how in ("has", "lacks"):
            return rf"(?{'=' if self.how == 'has' else '!'}{start}(?=[\s=/>]))"
        v = rf"\Q{self.value}\E"
        test = {
            "is": rf"(?:\"{v}\"|'{v}'|{v}(?=[\s>]))",
            "begins": rf"[\"']?{v}",
            "holds": rf"(?:\"[^\"]*{v}|'[^']*{v}|[^\s\"'>]*{v})",
            "word": rf"(?:\"(?:[^\"]*\s)?{v}[\s\"]|'(?:[^']*\s)?{v}[\s']|{v}(?=[\s>]))",
        }[self.how]
        return rf"(?={start}\s*=\s*{f'(?i:{test})' if self.fold else test})"


@dataclass(frozen=True)
class AnyOf:
    """An opening tag that fits any of the tags."""

    tags: tuple[Tag, ...]
    name: str = ""

    def pattern(self) -> str:
        return "(?:" + "|".join(tag.pattern() for tag in self.tags) + ")"


Path = tuple["Tag | AnyOf", ...]


def bound(value: str, use: Callable[[str], str]) -> str:
    """``use(value)`` with the value worked out once, however often it is used."""
    return f"get(transform(array({value}), {_lambda(use, 'x')}), 0)"


def parts_at(text: str, start: str, mark: str = "<") -> str:
    """The text cut before each place where ``start`` (SQL, a pattern that begins with the mark) fits.

    Unlike ``split``, this compiles a constant pattern once, and tries it only where a mark is.
    """
    head, tail = literal(f"(?s).[^{mark}]*+(?:(?!"), literal(f"){mark}[^{mark}]*+)*+|^\\z")
    return f"regexp_extract_all({text}, concat({head}, {start}, {tail}), 0)"


def visible(page: str) -> str:
    """The page without comments, scripts, styles and templates; null gives ``''``."""
    return f"regexp_replace(coalesce({page}, ''), {literal(_HIDDEN)}, '<!>')"


def _read_entity(part: str) -> str:
    """A text that begins with an entity, with that entity as a character."""
    names = f"str_to_map({literal(_NAMES)}, {literal(chr(10))}, {literal(chr(9))})"
    old = "^&(" + "|".join(_LEGACY) + ");?"
    named = f"element_at({names}, regexp_extract({part}, '^&([a-zA-Z][a-zA-Z0-9]*);', 1))"
    legacy = f"element_at({names}, regexp_extract({part}, {literal(old)}, 1))"
    number = f"regexp_extract({part}, {literal(r'^&#([0-9]{1,7}|[xX][0-9a-fA-F]{1,6})(?![0-9a-fA-F])')}, 1)"

    def character(digits: str) -> str:
        value = f"CAST(if({digits} RLIKE '^[xX]', conv(substring({digits}, 2), 16, 10), {digits}) AS INT)"
        fits = lambda n: f"{n} BETWEEN 1 AND 1114111 AND NOT {n} BETWEEN 55296 AND 57343"
        shown = bound(value, lambda n: f"if({fits(n)}, decode(unhex(lpad(hex({n}), 8, '0')), 'UTF-32'), '\ufffd')")
        rest = f"regexp_replace({part}, {literal('^&#[xX]?[0-9a-fA-F]+;?')}, '')"
        return f"if({digits} = '', NULL, concat({shown}, {rest}))"

    return f"""coalesce({bound(number, character)},
        concat({named}, regexp_replace({part}, '^&[a-zA-Z0-9]+;', '')),
        concat({legacy}, regexp_replace({part}, {literal(old)}, '')), {part})"""


def unescape(text: str) -> str:
    """Entities to characters: numbers and the names of HTML 4, old names also without semicolon."""

    def whole(t: str) -> str:
        read = _lambda(lambda p: f"if(startswith({p}, '&'), {_read_entity(p)}, {p})", "p")
        return f"if(contains({t}, '&'), array_join(transform({parts_at(t, literal(_ENTITY), '&')}, {read}), ''), {t})"

    return bound(text, whole)


def plain_text(inner: str, between: str = "' '") -> str:
    """Text of an element, its pieces joined by ``between`` (SQL), white space collapsed."""
    bare = unescape(f"regexp_replace({inner}, {literal(_TAG)}, {between})")
    return f"trim(regexp_replace(coalesce({bare}, ''), {literal(f'[{SPACE}]+')}, ' '))"


def _upto(tokens: str, step: Callable[[str], str]) -> str:
    """The tokens before the one at which the sum of the steps first falls below 0, as one text."""

    def go(state: str, token: str) -> str:
        def advance(depth: str) -> str:
            return f"named_struct('depth', {depth}, 'kept', {state}.kept + if({depth} < 0, 0, 1))"

        return f"if({state}.depth < 0, {state}, {bound(f'{state}.depth + {step(token)}', advance)})"

    fold = f"aggregate({tokens}, named_struct('depth', 0, 'kept', 0), {_lambda(go, 's', 't')}, s -> s.kept)"
    return bound(fold, lambda n: f"array_join(slice({tokens}, 1, {n}), '')")


def _inner(tail: str, tag: Tag) -> str:
    """What lies inside the element with whose opening tag the text begins."""

    def named(name: str) -> str:
        edge = literal(r"\E[\s/>])")
        both, opens, closes = (
            f"concat({literal(k)}, {name}, {edge})" for k in (r"(?i:</?\Q", r"^(?i:<\Q", r"^(?i:</\Q")
        )
        closed = literal(r"^<[^>\"']*/>")

        def step(token: str) -> str:
            return f"CASE WHEN rlike({token}, {opens}) AND NOT rlike({token}, {closed}) THEN 1 WHEN rlike({token}, {closes}) THEN -1 ELSE 0 END"

        rest = f"regexp_replace({tail}, {literal(_OPENING)}, '')"
        return bound(parts_at(rest, both), lambda tokens: _upto(tokens, step))

    if tag.name:
        return named(literal(tag.name))
    return bound(f"regexp_extract({tail}, {literal(r'^<([a-zA-Z][^\s/>]*)')}, 1)", named)


def _cut(page: str, tag: Tag) -> str:
    return parts_at(page, literal(tag.pattern()))


def _own(parts: str, tag: Tag) -> str:
    """Places of the parts that begin with the tag."""
    fits = _lambda(lambda i: f"rlike(element_at({parts}, {i}), {literal('^' + tag.pattern())})", "i")
    return f"filter(sequence(1, size({parts})), {fits})"


def _tail(parts: str, place: str) -> str:
    return f"array_join(slice({parts}, {place}, size({parts})), '')"


def _tails(page: str, tag: Tag, use: Callable[[str], str]) -> str:
    """First result that is not null of ``use``, called with the page from each fitting tag on.

    Nothing is worked out after the first result.
    """

    def over(parts: str) -> str:
        go = _lambda(lambda found, i: f"coalesce({found}, {bound(_tail(parts, i), use)})", "f", "i")
        return f"aggregate({_own(parts, tag)}, CAST(NULL AS STRING), {go})"

    return bound(_cut(page, tag), over)


def first_inner(page: str, path: Sequence[Tag]) -> str:
    """What lies inside the first element that fits the path, null where none does.

    Each tag of a path lies somewhere inside an element that fits the tag before it.
    """

    def use(tail: str) -> str:
        inner = _inner(tail, path[0])
        return inner if len(path) == 1 else bound(inner, lambda x: first_inner(x, path[1:]))

    return _tails(page, path[0], use)


def first_texts(page: str, facts: dict[str, Sequence[Path]], joined: Sequence[str] = ()) -> str:
    """Struct with, per fact, the text of its first path whose first element has any, else ``''``.

    For the facts in ``joined`` the pieces of the first path's text follow each other without a blank.
    """
    inners, places = [], {}
    for name, paths in facts.items():
        places[name] = range(len(inners), len(inners) + len(paths))
        for i, path in enumerate(paths):
            between = "''" if i == 0 and name in joined else "' '"
            inners.append(f"named_struct('html', {first_inner(page, path)}, 'between', {between})")
    read = _lambda(lambda x: plain_text(f"{x}.html", f"{x}.between"), "x")

    def chosen(texts: str) -> str:
        one = lambda name: ", ".join(f"nullif(get({texts}, {i}), '')" for i in places[name])
        return "named_struct(" + ", ".join(f"'{n}', coalesce({one(n)}, '')" for n in facts) + ")"

    return bound(f"transform(array({', '.join(inners)}), {read})", chosen)


def without_first(page: str, tag: Tag) -> str:
    """The page without the first element that the tag opens."""

    def drop(tail: str) -> str:
        opened = f"length(regexp_extract({tail}, {literal(_OPENING)}, 0))"
        return f"substring({tail}, length({_inner(tail, tag)}) + {opened} + 1)"

    def cut(parts: str) -> str:
        kept = f"concat(element_at({parts}, 1), {bound(f'element_at({parts}, 2)', drop)})"
        return f"if(size({parts}) < 2, {page}, {kept})"

    return bound(f"split({page}, {literal(f'(?={tag.pattern()})')}, 2)", cut)


def beside_labels(page: str, prefixes: Sequence[str], label: Tag, value: Tag) -> str:
    """Array with, for each prefix, the text of the value element after the first label that starts with it, any case.

    The value must lie in the element that holds the label; ``''`` where there is none.  Labels are read once
    for all prefixes.
    """
    alone = literal(rf"^<(?:/?(?i:{_VOID})[\s/>]|[^>]*/>)")

    def step(token: str) -> str:
        return f"CASE WHEN rlike({token}, {alone}) THEN 0 WHEN rlike({token}, '^</[a-zA-Z]') THEN -1 WHEN rlike({token}, '^<[a-zA-Z]') THEN 1 ELSE 0 END"

    def read(tail: str) -> str:
        def both(inner: str) -> str:
            opened = f"length(regexp_extract({tail}, {literal(_OPENING)}, 0))"
            after = f"substring({tail}, {opened} + length({inner}) + 1)"
            return f"named_struct('text', lower({plain_text(inner)}), 'after', {after})"

        return bound(_inner(tail, label), both)

    def over(parts: str) -> str:
        return f"transform({_own(parts, label)}, {_lambda(lambda i: bound(_tail(parts, i), read), 'i')})"

    def beside(rest: str) -> str:
        # What follows the label reaches to the end tag of the element that holds it.
        held = bound(parts_at(rest, literal("</?[a-zA-Z]")), lambda tokens: _upto(tokens, step))
        return bound(held, lambda h: f"nullif({plain_text(first_inner(h, (value,)))}, '')")

    def chosen(labels: str) -> str:
        def first(prefix: str) -> str:
            def go(found: str, own: str) -> str:
                rest = f"regexp_replace({own}.after, {literal(f'^</[a-zA-Z]{_REST}')}, '')"
                return f"coalesce({found}, if(startswith({own}.text, {literal(prefix.lower())}), {beside(rest)}, NULL))"

            return f"coalesce(aggregate({labels}, CAST(NULL AS STRING), {_lambda(go, 'f', 'l')}), '')"

        return f"array({', '.join(map(first, prefixes))})"

    return bound(bound(_cut(page, label), over), chosen)


def beside_label(page: str, prefix: str, label: Tag, value: Tag) -> str:
    """The text of ``beside_labels`` for one prefix."""
    return f"get({beside_labels(page, [prefix], label, value)}, 0)"


def attribute(opening: str, name: str) -> str:
    """Value of an attribute of an opening tag, ``''`` where it has none."""
    pattern = literal(rf"(?i)[\s\"']{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
    return unescape("concat(" + ", ".join(f"regexp_extract({opening}, {pattern}, {k})" for k in (1, 2, 3)) + ")")


def anchors(page: str) -> str:
    """``array<struct<href, text>>`` of the links, in page order."""
    tag = Tag("a", "href", how="has")
    start = literal("^" + tag.pattern())

    def link(part: str) -> str:
        inner = f"regexp_replace(regexp_replace({part}, {start}, ''), {literal(r'(?is)</a[\s>].*')}, '')"
        return f"named_struct('href', {attribute(f'regexp_extract({part}, {start}, 0)', 'href')}, 'text', {plain_text(inner)})"

    own = f"filter({_cut(page, tag)}, {_lambda(lambda p: f'rlike({p}, {start})', 'p')})"
    return f"transform({own}, {_lambda(link, 'p')})"


def anchors_within(page: str, tag: Tag) -> str:
    """Links inside the elements that the tag opens, in page order; nested elements count once."""

    def over(parts: str) -> str:
        # An element that begins before the end of the last one lies inside it.
        def go(state: str, place: str) -> str:
            def add(inner: str) -> str:
                return f"named_struct('found', concat({state}.found, array({inner})), 'end', {at} + length({inner}))"

            at = f"length(array_join(slice({parts}, 1, {place} - 1), ''))"
            more = bound(_tail(parts, place), lambda tail: bound(_inner(tail, tag), add))
            return f"if({at} < {state}.end, {state}, {more})"

        start = "named_struct('found', CAST(array() AS array<string>), 'end', 0)"
        return f"aggregate({_own(parts, tag)}, {start}, {_lambda(go, 's', 'i')}, s -> s.found)"

    each = _lambda(anchors, "e")
    return f"flatten(transform({bound(_cut(page, tag), over)}, {each}))"


def elements(page: str, tag: Tag, use: Callable[[str, str], str]) -> str:
    """An array with ``use(inner, before)`` for each element that the tag opens, in page order.

    ``inner`` is what lies inside the element, ``before`` the page up to it.  Nested elements count, too.
    """

    def over(parts: str) -> str:
        def one(place: str) -> str:
            before = f"array_join(slice({parts}, 1, {place} - 1), '')"
            inner = bound(_tail(parts, place), lambda tail: _inner(tail, tag))
            both = f"named_struct('inner', {inner}, 'before', {before})"
            return bound(both, lambda b: use(f"{b}.inner", f"{b}.before"))

        return f"transform({_own(parts, tag)}, {_lambda(one, 'i')})"

    return bound(_cut(page, tag), over)


def open_link(before: str) -> str:
    """Array with the href of the link that is still open where the text ends; empty where none is."""
    tag = Tag("a", "href", how="has")
    opened = literal("^" + tag.pattern())

    def last(token: str) -> str:
        href = attribute(f"regexp_extract({token}, {opened}, 0)", "href")
        is_open = f"rlike({token}, {opened}) AND NOT rlike({token}, {literal(r'^<[^>]*/>')})"
        return f"if({is_open}, array({href}), CAST(array() AS array<string>))"

    # The rest from the last tag of a link on.
    rest = f"regexp_extract({before}, {literal(r'(?s).*(</?[aA][\s/>].*)')}, 1)"
    return bound(rest, last)
