"""Labelled pages for the classifier of htmlmain: layouts of sites with their main text known.

Each page mixes ways in which sites mark up the same things: semantic elements or plain div with classes, themes that put
states and subjects into class tokens, and parts without any mark, which only links and length tell apart.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

#: Class tokens of themes that say nothing about whether the element is content.
STATES = ("has-sidebar", "with-sidebar", "no-sidebar", "tag-politics", "tag-news", "category-legal", "category-tags", "type-post", "status-publish", "hentry", "format-standard", "share-enabled", "search-result", "post-12", "clearfix", "row", "wide", "js-loaded", "author-menu")
WRAPS = ("wrap", "container", "page", "layout", "site", "row", "wrapper", "inner", "grid")
CONTENT = ("content", "post-content", "entry-content", "article-body", "story", "entry", "post", "main-content", "text", "page-content", "td-post-content")
PARTS = {
    "nav": (("nav", ""), ("div", "nav"), ("div", "main-menu"), ("div", "navbar"), ("ul", "menu"), ("div", "navigation"), ("div", "breadcrumbs"), ("ul", "")),
    "header": (("header", ""), ("div", "header"), ("div", "site-header"), ("div", "masthead"), ("div", "topbar")),
    "footer": (("footer", ""), ("div", "footer"), ("div", "site-footer"), ("div", "copyright"), ("div", "footer-widgets")),
    "side": (("aside", ""), ("div", "sidebar"), ("div", "widget-area widget"), ("div", "related-posts related"), ("section", "recommended"), ("div", "widget")),
    "ad": (("div", "ad"), ("div", "ads"), ("div", "advert"), ("div", "ad-slot"), ("div", "promo"), ("div", "sponsored"), ("ins", "advertisement")),
    "notice": (("div", "cookie-notice"), ("div", "cookie-banner"), ("div", "consent"), ("div", "newsletter"), ("div", "notice"), ("div", "popup"), ("dialog", "")),
    "form": (("form", ""), ("form", "search-form"), ("div", "login"), ("form", "newsletter-signup")),
    "comments": (("section", "comments"), ("div", "comments-area"), ("ol", "comment-list"), ("div", "comments"), ("div", "disqus"), ("section", "replies")),
    "share": (("div", "share"), ("div", "social-links"), ("ul", "sharing"), ("div", "post-tags"), ("div", "pagination")),
}


def _words(rng: random.Random, low: int, high: int) -> str:
    return " ".join("".join(rng.choice("aeioubcdfghklmnprstvwz") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(low, high)))


def _sentence(rng: random.Random, low: int, high: int) -> str:
    return _words(rng, low, high).capitalize() + rng.choice(("..", ".", ".", "?", "!"))[-1]


def _part(rng: random.Random, kind: str) -> str:
    tag, marks = rng.choice(PARTS[kind])
    where = f' {rng.choice(("class", "class", "id"))}="{marks}"' if marks else ""
    link = lambda: f'<a href="/{rng.randint(1, 999)}">{_words(rng, 1, 3)}</a>'
    many = lambda f: "".join(f() for _ in range(rng.randint(1, 5)))
    if kind in ("nav", "share"):
        body = many(lambda: f"<li>{link()}</li>")
        body = body if tag == "ul" else f"<ul>{body}</ul>"
    elif kind == "header":
        body = f"<div>{_words(rng, 1, 4)}</div>" + (f"<p>{_words(rng, 3, 9)}</p>" if rng.random() < 0.5 else "")
    elif kind == "footer":
        body = f"<p>{_words(rng, 2, 20)}</p>" if rng.random() < 0.6 else f"&copy; {_words(rng, 2, 12)}."
        body += many(link) if rng.random() < 0.5 else ""
    elif kind == "side":
        body = f"<h3>{_words(rng, 1, 4)}</h3>" + many(lambda: f"<p>{_sentence(rng, 4, 40)}</p>" if rng.random() < 0.5 else f"<li>{link()}</li>")
    elif kind == "form":
        body = f"<label>{_words(rng, 1, 3)}</label><p>{_sentence(rng, 2, 12)}</p><input>"
    elif kind == "comments":
        each = lambda: f"<p>{_sentence(rng, 3, 60)}</p>"
        body = many((lambda: f"<li>{each()}</li>") if tag == "ol" else each)
    else:
        body = rng.choice((f"<p>{_sentence(rng, 4, 30)}</p>", _sentence(rng, 3, 25), f"<p>{_sentence(rng, 3, 12)} {link()}</p>"))
    return f"<{tag}{where}>{body}</{tag}>"


def _article(rng: random.Random) -> tuple[str, set[str]]:
    own: set[str] = set()

    def told(text: str) -> str:
        own.add(text)
        return text

    out = [f"<h1>{told(_words(rng, 2, 12))}</h1>"] if rng.random() < 0.85 else []
    out = [f"<header>{out[0]}</header>"] if out and rng.random() < 0.2 else out
    for _ in range(rng.randint(1, 9)):
        kind = rng.random()
        if kind < 0.7:
            out.append(f"<p>{told(_sentence(rng, 3, 120))}</p>")
        elif kind < 0.8:
            out.append(f"<h2>{told(_words(rng, 1, 7))}</h2>")
        elif kind < 0.88:
            out.append("<ul>" + "".join(f"<li>{told(_words(rng, 1, 14))}</li>" for _ in range(rng.randint(2, 5))) + "</ul>")
        elif kind < 0.93:
            out.append(f"<blockquote>{told(_sentence(rng, 5, 40))}</blockquote>")
        elif kind < 0.96:
            out.append("<table>" + "".join(f"<tr><td>{told(_words(rng, 1, 5))}</td><td>{told(_words(rng, 1, 5))}</td></tr>" for _ in range(2)) + "</table>")
        else:
            out.append(_part(rng, rng.choice(("ad", "share", "notice"))))
    marks = [rng.choice(STATES) for _ in range(rng.randint(0, 3))]
    style = rng.random()
    if style < 0.4:
        tag = "article"
    elif style < 0.5:
        tag = "main"
    else:
        tag = "div"
        marks += [rng.choice(CONTENT)] if style < 0.9 else []
    rng.shuffle(marks)
    where = f' class="{" ".join(marks)}"' if marks else ""
    body = f"<{tag}{where}>{''.join(out)}</{tag}>"
    return (f"<main>{body}</main>" if tag == "article" and rng.random() < 0.3 else body), own


def labelled_pages(n: int, seed: int) -> Iterator[tuple[str, set[str]]]:
    """n pages and, of each, the texts of its content blocks."""
    rng = random.Random(seed)
    for _ in range(n):
        body, own = _article(rng)
        before = [_part(rng, k) for k in ("notice", "header", "nav", "ad", "form") if rng.random() < 0.55]
        after = [_part(rng, k) for k in ("share", "side", "comments", "ad", "form", "footer", "nav") if rng.random() < 0.5]
        side = _part(rng, "side") if rng.random() < 0.3 else ""
        wraps = rng.randint(0, 3)
        page = f"{side}{body}" if rng.random() < 0.5 else f"{body}{side}"
        for _ in range(wraps):
            marks = " ".join([rng.choice(WRAPS), *[rng.choice(STATES) for _ in range(rng.randint(0, 2))]])
            page = f'<div class="{marks}">{page}</div>'
        yield f"<html><head><title>{_words(rng, 2, 6)}</title></head><body>{''.join(before)}{page}{''.join(after)}</body></html>", own
