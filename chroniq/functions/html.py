"""HTML expressions.

Pages are tag soup, so XML functions cannot read them. One regular expression cuts a page
into tokens; comments, and the raw text inside ``script`` and ``style``, are whole tokens,
so markup-like text in them is never taken for a tag.

An element is closed by its own end tag or by that of an element around it; void elements have none.
Names of the older character references are known without ``;`` in text, as browsers read them.
"""

from __future__ import annotations

from collections.abc import Callable
from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from chroniq.functions.text import captures, collapse_whitespace, keep_by_walk, let, literal_map, strip

_COMMENT = r"<!--.*?(?:-->|\z)"
_RAW = r"<(?:script|style)(?=[\s/>]).*?(?:</(?:script|style)\s*>|\z)"
_TAG_REST = r"""[^>=]*+(?:=\s*+(?:"[^"]*+"|'[^']*+')?+[^>=]*+)*+>?"""
_TAG = rf"<[/!?]?[a-zA-Z]{_TAG_REST}"
_DROPPED = rf"(?s)<(?:{_COMMENT[1:]}|{_TAG[1:]})"
_CUT = "\u0002"
_SHIELD = "\u0003"
_RUN = 512  # letters that a walk gathers before it moves them on


def _element(name: str) -> str:
    return rf"{name}(?=[\s/>])"


def _between(name: str) -> str:
    """Tokens: the tags of one element, and all that lies between two of them."""
    other = rf"[^<]++|{_COMMENT}|{_RAW}|<(?!/?{_element(name)}|!--|(?:script|style)(?=[\s/>])){_TAG_REST}"
    # Possessive, so that the regex engine loops over the run and never recurses.
    return rf"(?is)</?{_element(name)}{_TAG_REST}|(?:{other})++|<"


def _raw_attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of the tag that starts ``tag``, entities left in; null if absent."""
    own_tag = F.regexp_extract(tag, rf"(?s)\A<{_TAG_REST}", 0)
    # Quoted values are taken whole, so nothing inside one looks like an attribute.
    pairs = F.regexp_extract_all(
        own_tag, F.lit(r"""[^\s=/>"'<]+\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>]+)"""), F.lit(0)
    )
    pair = F.get(F.filter(pairs, lambda p: F.rlike(p, F.lit(rf"(?i)\A{name}\s*="))), F.lit(0))
    value = F.regexp_replace(pair, r"(?s)\A[^=]*=\s*", "")
    return F.regexp_replace(value, r"""(?s)\A(["'])(.*)\1\z""", "$2")


_ENTITIES = {name: chr(code) for name, code in name2codepoint.items()}


def _decode_numeric(part: Column) -> Column:
    """``part`` starts with ``#``; null if it is no valid reference."""
    # Eight digits are more than any valid code has, and still fit a number.
    pattern = r"(?s)\A#(?:([0-9]{1,8}+)|[xX]([0-9A-Fa-f]{1,8}+))(?![0-9]);?(.*)\z"

    def read(groups: Column) -> Column:
        code = F.when(groups[0] != "", groups[0]).otherwise(F.conv(groups[1], 16, 10)).cast("bigint")
        valid = code.between(32, 0xD7FF) | code.between(0xE000, 0x10FFFF) | code.isin(9, 10, 13)
        symbol = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(valid, F.concat(symbol, groups[2]))

    return let(captures(part, pattern, 3), read)


#: The names that HTML knows without ``;``, the longest first.
_LEGACY = {name: html5[name] for name in sorted(html5, key=lambda n: (-len(n), n)) if not name.endswith(";")}


def _decode_legacy(part: Column, attribute: bool) -> Column:
    """``part`` starts with a name that needs no ``;``; null if it does not. In an attribute ``&copy=1`` is no reference."""
    ahead = "(?![0-9A-Za-z=])" if attribute else ""
    name = F.regexp_extract(part, rf"\A({'|'.join(_LEGACY)}){ahead}", 1)
    return F.when(name != "", F.concat(F.try_element_at(literal_map(_LEGACY), name), F.substr(part, F.length(name) + 1)))


def _decode_one(part: Column, attribute: bool = False) -> Column:
    """``part`` is what follows one ampersand."""
    name = F.substring_index(part, ";", 1)
    named = F.when(
        F.length(name).between(2, 8) & (F.length(name) < F.length(part)),
        F.concat(F.try_element_at(literal_map(_ENTITIES), name), F.substr(part, F.length(name) + 2)),
    )
    numeric = F.when(F.startswith(part, F.lit("#")), _decode_numeric(part))
    return F.coalesce(named, numeric, _decode_legacy(part, attribute), F.concat(F.lit("&"), part))


def decode_entities(text: Column, attribute: bool = False) -> Column:
    """Decode each character reference once: ``&amp;lt;`` becomes ``&lt;``."""

    def decode(value: Column) -> Column:
        parts = F.split(value, "&")
        tail = F.transform(F.slice(parts, F.lit(2), F.size(parts)), lambda part: _decode_one(part, attribute))
        return F.concat(F.element_at(parts, 1), F.array_join(tail, ""))

    return let(text, lambda value: F.when(F.contains(value, F.lit("&")), decode(value)).otherwise(value))


def _marked_token(token: Column) -> Column:
    """A token with its markup turned into the cut mark, and the ampersands of raw text shielded."""
    raw = F.regexp_replace(token, rf"(?is)\A<(?:script|style){_TAG_REST}|</(?:script|style)\s*>\z", _CUT)
    return (
        F.when(~F.startswith(token, F.lit("<")) | (token == "<"), token)
        .when(F.rlike(F.substring(token, 1, 8), F.lit(r"(?i)\A<(?:script|style[\s/>])")), F.replace(raw, F.lit("&"), F.lit(_SHIELD)))
        .otherwise(F.lit(_CUT))
    )


def text_content(html: Column) -> Column:
    """All text of a fragment, with no separator where a tag was."""
    tokens = F.regexp_extract_all(html, F.lit(rf"(?is){_COMMENT}|{_RAW}|{_TAG}|[^<]+|<"), F.lit(0))
    careful = F.array_join(F.transform(tokens, _marked_token), "")
    # The mark keeps `&am` and `p;` on two sides of a tag apart until entities are decoded.
    marked = F.when(F.rlike(html, F.lit(r"(?i)<(?:script|style)")), careful).otherwise(
        F.regexp_replace(html, _DROPPED, _CUT)
    )
    return F.translate(decode_entities(marked), _SHIELD + _CUT, "&")


def _opens(token: Column, name: str) -> Column:
    return F.rlike(F.substring(token, 1, len(name) + 2), F.lit(rf"(?i)\A<{name}[\s/>]"))


def _step(token: Column, name: str) -> Column:
    """1 for a start tag, -1 for an end tag, else 0. Only the first characters are looked at."""
    closes = F.rlike(F.substring(token, 1, len(name) + 3), F.lit(rf"(?i)\A</{name}[\s/>]"))
    return F.when(_opens(token, name), 1).when(closes, -1).otherwise(0)


def _has_class_part(token: Column, class_part: str) -> Column:
    # The cheap test comes first; most tags do not have the name anywhere.
    inside = F.coalesce(F.contains(_raw_attribute(token, "class"), F.lit(class_part)), F.lit(False))
    return F.contains(token, F.lit(class_part)) & inside


def _class_is(token: Column, class_value: str) -> Column:
    same = F.coalesce(_raw_attribute(token, "class") == class_value, F.lit(False))
    return F.contains(token, F.lit(class_value)) & same


def _tokens(html: Column, name: str) -> Column:
    return F.regexp_extract_all(html, F.lit(_between(name)), F.lit(0))


#: Elements without content and without an end tag.
VOID = "area base br col embed hr img input link meta param source track wbr".split()
#: Start tags that end an open paragraph.
BLOCKS = (
    "address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul"
).split()
#: A start tag that ends an open element of one of these names.
SIBLINGS = {"li": ["li"], "dt": ["dt", "dd"], "dd": ["dt", "dd"], "td": ["td", "th"], "th": ["td", "th"], "tr": ["tr", "td", "th"], "option": ["option"]}


def _tag_name(token: Column) -> Column:
    """Lower-case name of a start or end tag; empty for anything else."""
    return F.lower(F.regexp_extract(token, r"\A</?([a-zA-Z][^\s/>]*)", 1))


def _before(stack: Column, name: Column) -> Column:
    """The stack without the last element of that name and all that is in it; the whole stack if there is none."""
    place = F.array_position(F.reverse(stack), name).cast("int")
    return F.when(place > 0, F.slice(stack, F.lit(1), F.size(stack) - place)).otherwise(stack)


def _closed_by(stack: Column, name: Column) -> Column:
    """The stack without what a start tag closes."""
    top = F.coalesce(F.element_at(F.concat(F.array(F.lit("")), stack), -1), F.lit(""))
    closes = (top == "p") & name.isin(*BLOCKS)
    for after, ended in SIBLINGS.items():
        closes = closes | ((name == after) & top.isin(*ended))
    return F.when(closes, F.slice(stack, F.lit(1), F.size(stack) - 1)).otherwise(stack)


def _walked_container(html: Column, is_start: Callable[[Column], Column]) -> Column:
    """The first matching element, found by a walk with the stack of open elements; null if there is none."""
    tokens = F.regexp_extract_all(html, F.lit(rf"(?is){_COMMENT}|{_RAW}|{_TAG}|[^<]+|<"), F.lit(0))

    def step(state: Column, token: Column) -> Column:
        return let(_tag_name(token), lambda name: move(state, token, name))

    def move(state: Column, token: Column, name: Column) -> Column:
        ends = F.startswith(token, F.lit("</"))
        raw = name.isin("script", "style")  # a whole element in one token
        tag = (name != "") & ~raw
        left = F.when(~tag, state["stack"]).when(ends, _before(state["stack"], name)).otherwise(_closed_by(state["stack"], name))

        def after(left: Column) -> Column:
            opens = tag & ~ends & ~name.isin(*VOID)
            begins = (state["level"] == 0) & opens & is_start(token)
            over = (state["level"] > 0) & (F.size(left) < state["level"])
            level = F.when(begins, F.size(left) + 1).when(over, F.lit(-1)).otherwise(state["level"])
            at = F.struct(F.when(opens, F.concat(left, F.array(name))).otherwise(left).alias("stack"), level.alias("level"))
            return F.struct(at.alias("at"), (begins | ((state["level"] > 0) & ~over)).alias("kept"))

        return let(left, after)

    start = {"stack": F.array().cast("array<string>"), "level": F.lit(0)}
    return let(keep_by_walk(tokens, start, step), lambda kept: F.when(F.size(kept) > 0, F.array_join(kept, "")))


def _has_stray_end(fragment: Column) -> Column:
    """Whether a fragment closes something that it does not open."""
    tags = F.regexp_replace(fragment, rf"(?is)<(?:{_COMMENT[1:]}|{_RAW[1:]})", "")

    def stray(lowered: Column, ends: Column, starts: Column) -> Column:
        def unopened(name: Column) -> Column:
            more = F.size(F.filter(ends, lambda e: e == name)) > F.size(F.filter(starts, lambda x: x == name))
            return more | (F.position(F.concat(F.lit("</"), name), lowered) < F.position(F.concat(F.lit("<"), name), lowered))

        return F.exists(F.array_distinct(ends), unopened)

    def names(tags: Column, before: str) -> Column:
        return F.transform(F.regexp_extract_all(tags, F.lit(rf"{before}([a-zA-Z][^\s/>]*)"), F.lit(1)), F.lower)

    # The fragment is cleaned and lower-cased once, and its names are listed once.
    return let(
        tags,
        lambda tags: let(F.lower(tags), lambda low: let(names(tags, "</"), lambda ends: let(names(tags, "<"), lambda starts: stray(low, ends, starts)))),
    )


def container(html: Column, name: str, class_part: str | None = None) -> Column:
    """Markup of the first matching element; null if there is none.

    Where the element has its own end tag and closes nothing that it does not open, counting its own name's tags finds the end. All
    other pages are walked with the stack of open elements, in which an end tag closes what it encloses.
    """

    def is_start(token: Column) -> Column:
        opens = _opens(token, name)
        return opens if class_part is None else opens & _has_class_part(token, class_part)

    def cut(rest: Column) -> Column:
        zero = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("taken"), F.lit(False).alias("done"))

        def walk(state: Column, step: Column) -> Column:
            depth = state["depth"] + step
            return F.when(state["done"], state).otherwise(
                F.struct(
                    depth.alias("depth"), (state["taken"] + 1).alias("taken"), (depth == 0).alias("done")
                )
            )

        steps = F.transform(rest, lambda token: _step(token, name))
        taken = F.aggregate(steps, zero, walk, lambda state: F.when(state["done"], state["taken"]))
        return F.array_join(F.slice(rest, F.lit(1), taken), "")

    def find(tokens: Column) -> Column:
        start = F.array_position(F.transform(tokens, is_start), True).cast("int")
        # Null: no such element. Empty: one that is to be walked for.
        closed = lambda at: let(F.slice(tokens, at, F.size(tokens)), cut)
        sound = lambda found: F.when(found.isNotNull() & ~_has_stray_end(found), found).otherwise("")
        return let(start, lambda at: F.when(at > 0, let(closed(at), sound)))

    found = let(let(_tokens(html, name), find), lambda f: F.when(f == "", _walked_container(html, is_start)).otherwise(f))
    return found if class_part is None else F.when(F.contains(html, F.lit(class_part)), found)


def container_text(html: Column, name: str, class_part: str | None = None) -> Column:
    """Text of the first matching element, white space collapsed; null if there is none."""
    return let(
        container(html, name, class_part),
        lambda found: F.when(found.isNotNull(), collapse_whitespace(text_content(found))),
    )


def inside_nested(html: Column, name: str, outer_class: str, inner_class: str) -> Column:
    """Markup inside ``inner_class`` elements that lie inside ``outer_class`` ones, joined in page order.

    The walk leaves one letter per token, and the tokens are filtered by these letters at the end. Letters are
    gathered in short runs, so that a page's length adds no more than its share.
    """
    zero = F.struct(*[F.lit(0).alias(n) for n in ("depth", "outer", "inner")], F.lit("").alias("run"), F.lit("").alias("marks"))

    def mark(token: Column) -> Column:
        step = _step(token, name)
        opens = _opens(token, name)
        return F.struct(
            step.alias("step"),
            (opens & _class_is(token, outer_class)).alias("outer"),
            (opens & _class_is(token, inner_class)).alias("inner"),
        )

    def enter(level: Column, starts: Column, depth: Column, step: Column) -> Column:
        """Depth at which an element was entered; 0 outside of it."""
        return F.when((level == 0) & starts, depth).when((step == -1) & (depth < level), 0).otherwise(level)

    def walk(state: Column, tag: Column) -> Column:
        depth = state["depth"] + tag["step"]
        outer = enter(state["outer"], tag["outer"], depth, tag["step"])
        # The outer element must have been open before this tag.
        inner = enter(state["inner"], tag["inner"] & (state["outer"] > 0), depth, tag["step"])
        run = F.concat(state["run"], F.when(inner > 0, "1").otherwise("0"))
        full = F.octet_length(state["run"]) >= _RUN
        return F.struct(
            depth.alias("depth"),
            outer.alias("outer"),
            inner.alias("inner"),
            F.when(full, F.substring(run, _RUN + 1, 1)).otherwise(run).alias("run"),
            F.when(full, F.concat(state["marks"], state["run"])).otherwise(state["marks"]).alias("marks"),
        )

    def keep(tokens: Column) -> Column:
        marks = F.aggregate(F.transform(tokens, mark), zero, walk, lambda state: F.concat(state["marks"], state["run"]))
        return let(F.split(marks, ""), lambda kept: F.array_join(F.filter(tokens, lambda _, i: F.get(kept, i) == "1"), ""))

    return let(_tokens(html, name), keep)


def elements(html: Column, name: str, class_part: str | None = None) -> Column:
    """All elements ``name`` that do not nest (``a``, ``p``, ``h3``, ``li``), each as markup.

    One without an end tag ends where the next of its kind starts; ``p`` and ``li`` also end
    where a block starts or ends.
    """
    ends = rf"</{name}\s*>|<{_element(name)}"
    if name in ("p", "li"):
        ends += r"|</?(?:div|ul|ol|h[1-6]|section|article|body)(?=[\s/>])"
    inner = rf"[^<]*+(?:(?:{_COMMENT}|{_RAW}|(?!{ends})<)[^<]*+)*+"
    # All three begin alike, so that text is passed over by one comparison a character.
    pattern = rf"(?is)<(?:{_COMMENT[1:]}|{_RAW[1:]}|{_element(name)}{_TAG_REST}{inner}(?:</{name}\s*>)?)"
    found = F.regexp_extract_all(html, F.lit(pattern), F.lit(0))

    def wanted(token: Column) -> Column:
        opens = _opens(token, name)
        return opens if class_part is None else opens & _has_class_part(token, class_part)

    return F.filter(found, wanted)


def anchors(html: Column) -> Column:
    """``ARRAY<STRUCT<href, title>>`` of all links; ``href`` is null where the tag has none."""
    return F.transform(
        elements(html, "a"),
        lambda a: F.struct(
            decode_entities(_raw_attribute(a, "href"), attribute=True).alias("href"),
            collapse_whitespace(text_content(a)).alias("title"),
        ),
    )


def element_texts(html: Column, name: str, class_part: str | None = None) -> Column:
    return F.transform(elements(html, name, class_part), lambda e: strip(text_content(e)))
