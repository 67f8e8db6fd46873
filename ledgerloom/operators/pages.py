"""Tables from HTML pages, cut into tags and texts by one regular expression.

A page becomes an array of tokens: tags and the texts between them, cut once for all that
is looked for.  An element runs from its start tag to the end tag that matches it, counting
nested elements of the same name; paragraphs and list items that are never closed end
where a browser ends them.  Names may have any letter case and attributes any quoting.
Scripts, styles and comments are removed first, so markup inside them is never matched.

Ends are found for all elements of a kind at once: the depth of every tag is a running sum,
and in the order (depth, place) a start tag stands right before its end.  The work grows
with the tokens of a page, however many elements it has.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.arrays import sums_before
from ledgerloom.functions.numeric import let
from ledgerloom.functions.text import decode_entities, find_all, strip

HIDDEN = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
# A tag may hold ">" inside quotes; a "<" that starts no tag is text.
TOKEN = (
    r"""(?s)</?[a-zA-Z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>|</?[a-zA-Z][^>]*+>|<[!?][^>]*+>|[^<]++|<"""
)
ATTRIBUTE = r"""(?s)([^\s"'<>/=]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
# Tags whose start or end closes an open paragraph.
BLOCKS = (
    "address article aside blockquote body center dd details dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol pre section table "
    "tbody td tfoot th thead tr ul"
).split()
# Tags that hold list items.
LISTS = ("ul", "ol", "menu", "dir")


class Page(NamedTuple):
    """The tokens of a page, as arrays of one length, and the tags among them."""

    pieces: Column
    texts: Column  # the token if it is text, else empty
    tags: Column  # (place, name) of every tag in order; the name of an end tag has a slash


# What to take from a page: an array column.
Taken = Callable[[Page], Column]


def visible(html: Column) -> Column:
    """Page markup without scripts, styles and comments."""
    return F.regexp_replace(html, HIDDEN, " ")


def tokens(html: Column) -> Column:
    """Tags and texts of a page in order."""
    return find_all(html, TOKEN, 0)


def _tag_name(token: Column) -> Column:
    """``name`` of a start tag, ``/name`` of an end tag, a mark for a declaration, empty for a text."""
    name = F.lower(F.regexp_extract(token, r"^<(/?[a-zA-Z][^\s/>]*|[!?](?=.))", 1))
    return F.when(F.startswith(token, F.lit("<")), name).otherwise("")


def of_page(html: Column, body: Callable[[Page], Column]) -> Column:
    """``body`` of a page whose markup is cleaned and cut once, however much it takes."""

    def named(pieces: Column) -> Column:
        def cut(names: Column) -> Column:
            texts = F.zip_with(pieces, names, lambda piece, name: F.when(name == "", piece).otherwise(""))
            tags = F.filter(
                F.transform(names, lambda name, i: F.struct(i.alias("place"), name.alias("name"))),
                lambda tag: tag["name"] != "",
            )
            return let(
                F.struct(texts.alias("texts"), tags.alias("tags")),
                lambda both: body(Page(pieces, both["texts"], both["tags"])),
            )

        return let(F.transform(pieces, _tag_name), cut)

    return let(tokens(visible(html)), named)


def attribute(tag: Column, name: str) -> Column:
    """Decoded value of an attribute of a start tag; NULL when it has none."""
    names = F.transform(find_all(tag, ATTRIBUTE, 1), F.lower)
    values = find_all(tag, ATTRIBUTE, 2)

    def value_at(place: Column) -> Column:
        value = F.element_at(values, place.cast("int"))
        return decode_entities(F.regexp_replace(value, r"""(?s)^(["'])(.*)\1$""", "$2"))

    value = let(F.array_position(names, name), lambda place: F.when(place > 0, value_at(place)))
    # Most tags do not name it anywhere.
    return F.when(F.contains(F.lower(tag), F.lit(name)), value)


def _marks(tags: Column, tag: str) -> Column:
    """(place, step) of the tags that open or close elements ``tag``, in order.

    ``step`` is 1 for its start tag and -1 for its end tag; for list items 2 and -2 are
    starts and ends of lists; for paragraphs -1 is anything that closes one.
    """
    name = lambda mark: mark["name"]
    if tag == "li":
        starts, ends = list(LISTS), [f"/{x}" for x in LISTS]
        wanted = lambda mark: name(mark).isin([tag, f"/{tag}", *starts, *ends])
        step = lambda mark: (
            F.when(name(mark) == tag, 1).when(name(mark) == f"/{tag}", -1)
            .when(name(mark).isin(starts), 2).otherwise(-2)
        )
    else:
        closers = [f"/{tag}", *([*BLOCKS, *[f"/{x}" for x in BLOCKS]] if tag == "p" else [])]
        wanted = lambda mark: name(mark).isin([tag, *closers])
        step = lambda mark: F.when(name(mark) == tag, 1).otherwise(-1)
    return F.transform(
        F.filter(tags, wanted), lambda mark: F.struct(mark["place"], step(mark).alias("step"))
    )


def _keyed(marks: Column, tag: str) -> Column:
    """(key, place, step) of the marks: a start's end is the next mark of its key, if any.

    The key is the depth inside the element.  Items count lists: an item, its end tag, the
    next item and the end of the list have the same depth, and the start of a list no end.
    """
    if tag == "li":
        steps = F.transform(marks, lambda mark: F.when(mark["step"] == 2, 1).when(mark["step"] == -2, -1).otherwise(0))
        inside = lambda mark, before: before
    else:
        steps = F.transform(marks, lambda mark: mark["step"])
        inside = lambda mark, before: before + F.when(mark["step"] == 1, 1).otherwise(0)
    keyed = F.zip_with(
        marks, sums_before(steps),
        lambda mark, before: F.struct(
            inside(mark, before).alias("key"), mark["place"].alias("place"), mark["step"].alias("step")
        ),
    )
    return F.filter(keyed, lambda mark: mark["step"] != 2) if tag == "li" else keyed


def _spans(page: Page, tag: str) -> Column:
    """(start, end) of the elements ``tag`` in page order: places of its first and last tag.

    An element that nothing ends goes to the end of the page.
    """
    last = F.size(page.pieces)

    def matched(marks: Column) -> Column:
        def span(mark: Column, i: Column) -> Column:
            after = F.get(marks, i + 1)
            end = after["place"] if tag == "p" else F.when(after["key"] == mark["key"], after["place"])
            return F.when(
                mark["step"] == 1,
                F.struct(mark["place"].alias("start"), F.coalesce(end, last).alias("end")),
            )

        return F.array_compact(F.transform(marks, span))

    marks = _marks(page.tags, tag)
    if tag == "p":  # never holds another; any mark ends it
        return let(marks, matched)
    return F.sort_array(let(let(marks, lambda found: F.sort_array(_keyed(found, tag))), matched))


def _text(page: Page, span: Column) -> Column:
    """Decoded text between the tags of an element, ends trimmed."""
    inside = F.slice(page.texts, span["start"] + 2, F.greatest(span["end"] - span["start"] - 1, F.lit(0)))
    return strip(decode_entities(F.array_join(inside, "")))


def _start(page: Page, span: Column) -> Column:
    return F.get(page.pieces, span["start"])


def _class_of(start: Column) -> Column:
    """Class attribute of a start tag; empty when it has none."""
    return strip(F.coalesce(attribute(start, "class"), F.lit("")))


def _with_class(start: Column, class_name: str) -> Column:
    """Whether a start tag has the class.

    An empty text stands for no (or an empty) class, several words for the exact
    attribute, one word for any element that has it among others.
    """
    if class_name == "" or " " in class_name:
        return _class_of(start) == class_name
    return F.array_contains(F.split(_class_of(start), r"\s+"), class_name)


def texts_of(tag: str, class_name: str | None = None) -> Taken:
    """Texts of the elements ``tag`` in page order; None takes every class."""

    def take(page: Page) -> Column:
        spans = _spans(page, tag)
        if class_name is not None:
            spans = F.filter(spans, lambda span: _with_class(_start(page, span), class_name))
        return F.transform(spans, lambda span: _text(page, span))

    return take


def links_of(class_name: str | None = None) -> Taken:
    """(link, title) of the ``<a href>`` elements in page order; the class attribute must match exactly."""

    def take(page: Page) -> Column:
        def pair(span: Column) -> Column:
            link = attribute(_start(page, span), "href")
            wanted = link.isNotNull()
            if class_name is not None:
                wanted = wanted & (_class_of(_start(page, span)) == class_name)
            return F.when(wanted, F.struct(link.alias("link"), _text(page, span).alias("title")))

        return F.array_compact(F.transform(_spans(page, "a"), pair))

    return take


def targets_of(class_name: str | None = None) -> Taken:
    """Targets of the ``<a href>`` elements in page order."""
    return lambda page: F.transform(links_of(class_name)(page), lambda pair: pair["link"])


def element_texts(html: Column, tag: str, class_name: str | None = None) -> Column:
    """``texts_of`` a page's markup."""
    return of_page(html, texts_of(tag, class_name))


def link_pairs(html: Column, class_name: str | None = None) -> Column:
    """``links_of`` a page's markup."""
    return of_page(html, links_of(class_name))


def elements(pages: DataFrame, tag: str, class_name: str | None = None) -> DataFrame:
    """One row per element: ``page_id``, ``position`` (from 0), ``text``."""
    texts = element_texts(F.col("html"), tag, class_name)
    return pages.select("page_id", F.posexplode(texts).alias("position", "text"))


def links(pages: DataFrame, class_name: str | None = None) -> DataFrame:
    """One row per link: ``page_id``, ``position``, ``link``, ``title``."""
    pairs = link_pairs(F.col("html"), class_name)
    return pages.select("page_id", F.posexplode(pairs).alias("position", "pair")).select(
        "page_id", "position", "pair.link", "pair.title"
    )


def _side_by_side(arrays: Mapping[str, Column], shortest: bool) -> Column:
    """Arrays as one array of structs, padded with NULL or cut to the shortest."""
    sizes = [F.size(array) for array in arrays.values()]
    pick = F.least if shortest else F.greatest
    rows = pick(*sizes) if len(sizes) > 1 else sizes[0]
    places = F.slice(F.sequence(F.lit(0), rows), F.lit(1), rows)
    return F.transform(
        places, lambda i: F.struct(*[F.get(array, i).alias(name) for name, array in arrays.items()])
    )


def extract_records(
    pages: DataFrame, selectors: Mapping[str, tuple[str, str | None] | Taken],
    max_rows: int | None = None, shortest: bool = False,
) -> DataFrame:
    """Parallel element lists of a page side by side: ``page_id``, ``position``, one column each.

    ``selectors`` maps a column name to (tag, class), or to what is taken of a page.  Short
    lists are padded with NULL; with ``shortest`` all are cut to the shortest.  ``max_rows``
    keeps the first records of every page, the way a result page is cut to its listing.
    """
    taken = {name: what if callable(what) else texts_of(*what) for name, what in selectors.items()}

    def records(page: Page) -> Column:
        # All lists of a page leave the cut together, so it is made once.
        lists = F.struct(*[take(page).alias(name) for name, take in taken.items()])
        rows = let(lists, lambda found: _side_by_side({name: found[name] for name in taken}, shortest))
        return rows if max_rows is None else F.slice(rows, 1, max_rows)

    rows = F.posexplode(of_page(F.col("html"), records)).alias("position", "row")
    return pages.select("page_id", rows).select("page_id", "position", "row.*")


def ragged_rows(
    df: DataFrame, key: str, arrays: list[str], max_rows: int | None = None, shortest: bool = False
) -> DataFrame:
    """Arrays of unequal length to rows: key, ``position``, one column per array.

    Short arrays are padded with NULL; with ``shortest`` all are cut to the shortest.
    """
    zipped = F.arrays_zip(*[F.col(name) for name in arrays])
    if shortest:
        length = F.least(*[F.size(c) for c in arrays]) if len(arrays) > 1 else F.size(arrays[0])
        zipped = F.slice(zipped, F.lit(1), length)
    rows = df.select(key, F.posexplode(zipped).alias("position", "row")).select(
        key, "position", *[F.col(f"row.{name}").alias(name) for name in arrays]
    )
    return rows if max_rows is None else rows.filter(F.col("position") < max_rows)


def result_message(pages: DataFrame, class_name: str | None = None) -> DataFrame:
    """Per page how many links were found, and the message a user gets."""
    pairs = link_pairs(F.col("html"), class_name)
    found = pages.select("page_id", pairs.alias("pairs")).withColumn("n_found", F.size("pairs"))
    message = (
        F.when(F.col("n_found") == 0, F.lit("nothing found"))
        .when(F.col("n_found") == 1, F.concat(F.lit("found: "), F.col("pairs")[0]["link"]))
        .otherwise(F.lit("more than one result found"))
    )
    return found.select("page_id", "n_found", message.alias("message"))
