"""Reading web pages: one light parse per page, batched through Arrow."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements without content, and elements whose content is dropped.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = ("script", "style")


class _Page(HTMLParser):
    """Builds each element's markdown when the element closes.

    An end tag closes the nearest open element of its name and everything inside
    it; an end tag without an open element is ignored.  Comments and the document
    type count as text, as they do in the markdown this has to equal.
    """

    def __init__(self, dropped):
        super().__init__(convert_charrefs=True)
        self.dropped = frozenset(dropped)
        self.links: list[tuple[str, str]] = []
        # (tag, attributes, markdown parts, plain parts, child signatures, first code block)
        self.open = [self._element("", {})]

    def _element(self, tag, attrs):
        return {"tag": tag, "attrs": attrs, "md": [], "raw": [], "marks": [], "code": None, "words": [], "items": []}

    def handle_starttag(self, tag, attrs):
        self.open.append(self._element(tag, {k: v or "" for k, v in attrs}))
        if tag in VOID:
            self._close()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._close()

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth]["tag"] == tag:
                while len(self.open) > depth:
                    self._close()
                return

    def _text(self, data, plain=True):
        top = self.open[-1]
        top["md"].append(data)
        top["marks"].append(data)
        if plain:
            top["raw"].append(data)
            if data.strip():
                top["words"].append(data.strip())

    def handle_data(self, data):
        self._text(data)

    def handle_comment(self, data):
        self._text(data, plain=False)

    def handle_decl(self, decl):
        self._text(re.sub("(?i)^DOCTYPE ", "", decl), plain=False)

    def _close(self):
        e = self.open.pop()
        up = self.open[-1]
        if e["tag"] in self.dropped:
            return
        mark = (e["tag"], tuple(sorted(e["attrs"].items())), tuple(e["marks"]))
        up["marks"].append(mark)
        raw = "".join(e["raw"])
        up["raw"].append(raw)
        up["words"] += e["words"]
        code = (raw, e["attrs"].get("class", "")) if e["tag"] == "code" else e["code"]
        up["code"] = up["code"] or code
        if e["tag"] == "a":
            self.links.append(("".join(e["words"]), e["attrs"].get("href")))
        up["md"].append(self._markdown(e, up, mark))

    def _markdown(self, e, up, mark):
        tag, attrs, inner = e["tag"], e["attrs"], "".join(e["md"])
        if re.fullmatch("h[1-6]", tag):
            return f"\n{'#' * int(tag[1])} {inner.strip()}\n\n"
        if tag == "li":
            # Items are counted by their place among all children of the list.
            number = f"{up['marks'].index(mark) + 1}." if up["tag"] == "ol" else "-"
            return f"{number} {inner.strip()}\n"
        if tag == "pre":
            body, classes = e["code"] or (inner, "")
            language = next((c[9:] for c in classes.split() if c.startswith("language-")), "")
            return f"\n```{language}\n{body.strip()}\n```\n\n"
        if tag == "blockquote":
            return "\n" + "\n".join(f"> {line}" for line in inner.strip().split("\n")) + "\n\n"
        if tag == "code":
            return inner if up["tag"] == "pre" else f"`{inner}`"
        return {
            "p": f"\n{inner.strip()}\n\n",
            "strong": f"**{inner}**", "b": f"**{inner}**",
            "em": f"*{inner}*", "i": f"*{inner}*",
            "a": f"[{inner}]({attrs.get('href', '')})",
            "img": f"![{attrs.get('alt', '')}]({attrs.get('src', '')})",
            "ul": f"\n{inner}\n", "ol": f"\n{inner}\n",
            "hr": "\n---\n\n", "br": "  \n",
        }.get(tag, inner)

    def finish(self):
        self.close()
        while len(self.open) > 1:
            self._close()
        return self


def _read(page: str, dropped=DROPPED) -> _Page:
    parser = _Page(dropped)
    parser.feed(page)
    return parser.finish()


def html_to_markdown(page: Column, strip_tags: tuple[str, ...] = ()) -> Column:
    """Markdown of a web page without its styles, embedded code and ``strip_tags``."""
    dropped = (*DROPPED, *strip_tags)

    @F.pandas_udf("string")
    def convert(pages: pd.Series) -> pd.Series:
        def one(page):
            if page is None:
                return None
            return re.sub(r"\n{3,}", "\n\n", "".join(_read(page, dropped).open[0]["md"])).strip()

        return pages.map(one)

    return convert(page)


ANCHORS = T.ArrayType(
    T.StructType([T.StructField("text", T.StringType()), T.StructField("href", T.StringType())])
)


@F.pandas_udf(ANCHORS)
def _anchors(pages: pd.Series) -> pd.Series:
    def one(page):
        if page is None:
            return None
        return [
            {"text": text, "href": href}
            for text, href in _read(page).links
            if text and href and href.startswith("/")
        ]

    return pages.map(one)


def internal_links(page: Column, url: Column) -> Column:
    """Array of (text, absolute) for anchors with text and a path of the same site."""
    base = F.regexp_replace(url, "/+$", "")
    return F.transform(
        _anchors(page), lambda a: F.struct(a["text"].alias("text"), F.concat(base, a["href"]).alias("absolute"))
    )
