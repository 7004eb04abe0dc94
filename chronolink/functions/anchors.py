"""Links inside a text, as array columns worked out within the row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What an anchor looks like in each kind of text. A tag ends at the first > outside quotes; there
# are as many steps as quoted values, and none is taken back.
_IN_TAG = r"""[^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+"""
_OPEN = rf"<a(?=[\s/>]){_IN_TAG}>"
HTML_ANCHOR = rf"(?is){_OPEN}.*?</a\s*>"
HTML_LABEL = rf"(?is)^{_OPEN}(.*)</a\s*>$"
HTML_TAG = r"<[^>]*>"
# No markup is read inside comments, scripts and style sheets; one that is not closed goes on to the end.
HTML_HIDDEN = rf"<(?:!--.*?(?:-->|\z)|(?<code>script|style)(?=[\s/>]){_IN_TAG}>.*?(?:</\k<code>\s*>|\z))"
HTML_MAY_HIDE = r"(?i)<(?:!--|script|style)"
# One attribute of a tag, in double, single or no quotes.
_VALUE = r"""("[^"]*+"|'[^']*+'|[^\s"'>]++)"""
_OTHER = r"""(?:[\s/]++(?!{name}\s*=)[^\s"'>/=]++(?:\s*=\s*(?:"[^"]*+"|'[^']*+'|[^\s"'>]++))?)"""
# A target is followed by a section, a label or the closing brackets.
WIKI_LINK = r"\[\[([^\[\]|#]+)(?=\||\]\]|#[^\[\]|]*(?:\||\]\]))"
WIKI_ANCHOR = r"\[\[[^\[\]]*\]\]"
WIKI_COMMENT = r"(?s)<!--.*?-->"
WIKI_PLAIN = r"(?is)(?=<nowiki>)|(?<=</nowiki>)"
# Wiki links that put a page in a category or show a file; they lead to no page.
WIKI_NOT_LINKS = ("category:", "file:", "image:")
# Stands for square brackets that are no markup; not a character of any title.
BRACKET = "\ue000"

# Prefixes of titles that are no articles, the class of outside links, the longest title.
USER_PREFIXES = ("User:", "User talk:")
NON_ARTICLE_PREFIXES = ("/", "User:", "User talk:", "Talk:")
EXTERNAL_CLASS = "external"
TITLE_LIMIT = 256

# What the title of a link is taken from.
KINDS = ("title", "text", "href", "wikitext")


def anchors(text: Column | str, kind: str) -> Column:
    """All links of a text in order, as ``ARRAY<STRUCT<title, class>>``.

    ``kind`` says where titles are: the ``title`` attribute of HTML anchors, their ``text`` or
    ``href``, or the targets of ``wikitext`` links ``[[target|label]]``. A null text has no links.
    """
    text = F.col(text) if isinstance(text, str) else text
    if kind == "wikitext":
        titles = F.regexp_extract_all(_rendered(text), F.lit(WIKI_LINK), F.lit(1))
        titles = F.transform(titles, lambda t: F.trim(t))
        unlinked = [lambda t, p=p: F.lower(t).startswith(p) for p in WIKI_NOT_LINKS]
        titles = F.filter(titles, lambda t: ~_any(f(t) for f in unlinked))
        # A leading colon links to a category or file page instead of using it.
        titles = F.transform(titles, lambda t: F.regexp_replace(t, "^:", ""))
        found = F.transform(titles, lambda t: _link(t, F.lit(None).cast("string")))
    elif kind in ("title", "href", "text"):
        shown = F.when(text.rlike(HTML_MAY_HIDE), F.regexp_replace(text, f"(?is){HTML_HIDDEN}", "")).otherwise(text)
        whole = F.regexp_extract_all(shown, F.lit(HTML_ANCHOR), F.lit(0))
        found = F.transform(whole, lambda a: _link(_titled(a, kind), _attribute(a, "class")))
    else:
        raise ValueError(f"kind must be one of {KINDS}, not {kind!r}")
    nothing = F.array().cast("array<struct<title:string,class:string>>")
    return F.coalesce(found, nothing)


def without_anchors(text: Column | str, kind: str) -> Column:
    """The text with its links cut out, labels included; of wikitext also comments.

    What stands in HTML comments, scripts and style sheets is no link, so it stays.
    """
    if kind == "wikitext":
        shown = _rendered(F.col(text) if isinstance(text, str) else text)
        # A label may hold a link of its own, so the outer one is left for a second look.
        return F.regexp_replace(F.regexp_replace(shown, WIKI_ANCHOR, ""), WIKI_ANCHOR, "")
    text = F.col(text) if isinstance(text, str) else text
    # Hidden stretches are matched first and put back as they are.
    both = F.regexp_replace(text, rf"(?is)(?=<[!as])(?:({HTML_HIDDEN})|{HTML_ANCHOR})", "$1")
    return F.when(text.rlike(HTML_MAY_HIDE), both).otherwise(F.regexp_replace(text, HTML_ANCHOR, ""))


def without_tags(text: Column | str) -> Column:
    """The text with HTML tags cut out."""
    return F.regexp_replace(text, HTML_TAG, "")


def _rendered(text: Column) -> Column:
    """Wikitext without comments, with the brackets inside ``nowiki`` taken out of use.

    Few texts have either, and a look for them is much cheaper than the patterns.
    """
    shown = F.when(F.contains(text, F.lit("<!--")), F.regexp_replace(text, WIKI_COMMENT, "")).otherwise(text)
    plain = lambda p: F.when(
        F.lower(p).startswith("<nowiki>"), F.translate(p, "[]", BRACKET * 2)
    ).otherwise(p)
    whole = F.array_join(F.transform(F.split(shown, WIKI_PLAIN), plain), "")
    return F.when(F.contains(F.lower(text), F.lit("<nowiki>")), whole).otherwise(shown)


def is_basic_link(title: Column, css_class: Column) -> Column:
    """A titled link that leads neither to a user page nor outside."""
    return title.isNotNull() & ~_starts(title, USER_PREFIXES) & _inside(css_class)


def is_strict_link(title: Column, css_class: Column) -> Column:
    """A basic link that leads to no subpage or talk page and has a possible title.

    Judged on the title as written, before entities are replaced.
    """
    return (
        title.isNotNull()
        & ~_starts(title, NON_ARTICLE_PREFIXES)
        & _inside(css_class)
        & (F.length(title) < TITLE_LIMIT)
    )


def _link(title, css_class):
    return F.struct(title.alias("title"), css_class.alias("class"))


def _titled(anchor, kind):
    if kind != "text":
        return _attribute(anchor, kind)
    return F.regexp_replace(F.regexp_extract(anchor, HTML_LABEL, 1), HTML_TAG, "")


def _attribute(anchor, name):
    """Value of the first attribute of that name in the anchor's tag, quotes taken off; null if there is none."""
    pattern = rf"(?is)^<a{_OTHER.format(name=name)}*+[\s/]++{name}\s*=\s*{_VALUE}"
    value = F.regexp_extract(anchor, pattern, 1)
    return F.when(value != "", F.regexp_replace(value, "^[\"']|[\"']$", ""))


def _inside(css_class):
    return css_class.isNull() | ~css_class.contains(EXTERNAL_CLASS)


def _starts(title, prefixes):
    return _any(title.startswith(prefix) for prefix in prefixes)


def _any(conditions):
    result = F.lit(False)
    for condition in conditions:
        result = result | condition
    return result
