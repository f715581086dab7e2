"""Labelled pages for the content model.

A small grammar of page layouts writes pages whose elements say what they are
(``data-label``). The layouts differ in what marks the article (landmark
elements, class names, ids, tables or nothing), in what stands around and
inside it, and in how carelessly the markup is written.
"""

from __future__ import annotations

import random

_SYLLABLES = "ka lo mi ter an des ver un sol ra pe ti mon gra el is tur bo ne qui".split()
_ARTICLE = ["content", "main-content", "article-body", "post", "entry-content", "story", "post-text",
            "articleBody", "page-content", "blogpost body", "mainText"]
_MENU = ["nav", "menu", "navbar", "top-nav", "main-menu", "site-navigation", "breadcrumbs", "toolbar"]
_HEAD = ["header", "site-header", "masthead", "top-banner", "page-head"]
_FOOT = ["footer", "site-footer", "copyright", "foot", "bottom-footer"]
_SIDE = ["sidebar", "side", "widget", "right-rail", "related", "trending", "popular-posts", "more-stories"]
_ADS = ["ad", "ads", "advert", "ad-slot", "sponsored", "promo", "advertisement"]
_NOTICE = ["notice", "cookie-notice", "cookie-consent", "gdpr-banner", "alert", "newsletter", "popup", "disclaimer"]
_TALK = ["comments", "comment-list", "replies", "discussion", "reader-comments", "respond"]


class _Writer:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choice(_SYLLABLES) for _ in range(self.r.randint(1, 3)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(low, high)))

    def sentences(self, low: int, high: int) -> str:
        return " ".join(self.words(3, 14).capitalize() + "." for _ in range(self.r.randint(low, high)))

    def named(self, tag: str, names: list[str], inner: str, label: str | None = "other") -> str:
        key = self.r.choice(["class", "class", "id"])
        mark = f' data-label="{label}"' if label else ""
        return f'<{tag} {key}="{self.r.choice(names)}"{mark}>{inner}</{tag}>'

    def bare(self, tag: str, inner: str, label: str = "other") -> str:
        return f'<{tag} data-label="{label}">{inner}</{tag}>'

    def links(self, low: int = 2, high: int = 8) -> str:
        items = [f'<a href="/{self.word()}">{self.words(1, 3)}</a>' for _ in range(self.r.randint(low, high))]
        kind = self.r.randint(0, 2)
        if kind == 0:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return (" | " if kind == 1 else " ").join(items)

    # parts around and inside the article -----------------------------------

    def menu(self) -> str:
        return self.bare("nav", self.links()) if self.r.random() < 0.6 else self.named("div", _MENU, self.links())

    def head(self) -> str:
        inner = self.r.choice([f"<h1>{self.words(1, 3)}</h1>", f'<a href="/">{self.words(1, 2)}</a>',
                               f"<p>{self.words(2, 6)}</p>"]) + (self.links() if self.r.random() < 0.4 else "")
        return self.bare("header", inner) if self.r.random() < 0.5 else self.named("div", _HEAD, inner)

    def foot(self) -> str:
        inner = self.r.choice([f"&copy; {self.word()}.example &middot; {self.sentences(1, 2)}",
                               f"<p>© {self.words(1, 3)}. All rights reserved.</p>" + self.links(1, 4),
                               f"{self.words(2, 8)} {self.links(1, 3)}"])
        return self.bare("footer", inner) if self.r.random() < 0.6 else self.named("div", _FOOT, inner)

    def side(self) -> str:
        inner = f"<h3>{self.words(1, 3)}</h3>" + self.r.choice([
            self.links(), f"<p>{self.sentences(1, 3)}</p>", f"<ul><li>{self.words(3, 8)}</li><li>{self.words(3, 8)}</li></ul>"])
        return self.bare("aside", inner) if self.r.random() < 0.5 else self.named("div", _SIDE, inner)

    def advert(self) -> str:
        inner = self.r.choice([self.sentences(1, 3), f"<p>{self.sentences(1, 2)}</p>",
                               f'<a href="https://x.example">{self.words(2, 7)}</a>'])
        return self.named(self.r.choice(["div", "div", "section", "p"]), _ADS, inner)

    def notice(self) -> str:
        inner = self.r.choice([f"<p>{self.sentences(1, 3)}</p><button>{self.word()}</button>", self.sentences(1, 2)])
        return self.named(self.r.choice(["div", "section", "aside", "p", "dialog"]), _NOTICE, inner)

    def form(self) -> str:
        inner = (f"<label>{self.words(1, 3)}</label><input name=q>" + (f"<p>{self.sentences(1, 1)}</p>" if self.r.random() < 0.4 else "")
                 + f"<button>{self.words(1, 2)}</button>")
        return self.bare("form", inner)

    def talk(self) -> str:
        one = lambda: self.r.choice([
            f'<div class="comment"><b>{self.word()}</b><p>{self.sentences(1, 4)}</p></div>',
            f"<li><p>{self.sentences(1, 4)}</p></li>", f"<article><h4>{self.word()}</h4><p>{self.sentences(1, 3)}</p></article>"])
        inner = f"<h2>{self.words(1, 2)}</h2>" + "".join(one() for _ in range(self.r.randint(1, 4)))
        return self.named(self.r.choice(["section", "div", "ol"]), _TALK, inner)

    def script(self) -> str:
        return f'<script>var {self.word()}="</p>";track({self.r.randint(0, 99)});</script>'

    # the article -------------------------------------------------------------

    def paragraph(self) -> str:
        text = self.sentences(1, 6) if self.r.random() < 0.75 else self.r.choice(
            [self.words(1, 4).capitalize() + ".", self.words(4, 30), self.words(2, 12).upper() + "!!"])
        if self.r.random() < 0.15:
            text += f' <a href="/{self.word()}">{self.words(1, 4)}</a> {self.words(1, 6)}.'
        if self.r.random() < 0.1:
            text = f"<b>{self.words(1, 3)}</b> {text}<br>{self.words(1, 5)}"
        style = self.r.random()
        if style < 0.7:
            return f"<p>{text}</p>"
        if style < 0.85:
            return f"<p>{text}"  # unclosed
        return f"<p><b>{text}<br>"

    def block(self) -> str:
        kind = self.r.random()
        if kind < 0.72:
            return self.paragraph()
        if kind < 0.80:
            return f"<h2>{self.words(1, 6)}</h2>"
        if kind < 0.86:
            return "<ul>" + "".join(f"<li>{self.words(2, 12)}</li>" for _ in range(self.r.randint(1, 4))) + "</ul>"
        if kind < 0.90:
            return f"<blockquote>{self.sentences(1, 2)}</blockquote>"
        if kind < 0.93:
            return f"<pre>{self.words(3, 10)}\n{self.words(2, 8)}</pre>"
        if kind < 0.96:
            return "<table>" + "".join(f"<tr><td>{self.words(1, 4)}</td><td>{self.words(1, 3)}</td></tr>" for _ in range(2)) + "</table>"
        return f"<figure><img src=x><figcaption>{self.words(3, 9)}</figcaption></figure>"

    def article(self, strange: float) -> str:
        parts = [f"<h1>{self.words(2, 9)}</h1>"] if self.r.random() < 0.8 else []
        for _ in range(self.r.randint(1, 9)):
            parts.append(self.block())
            if self.r.random() < strange:
                parts.append(self.r.choice([self.advert, self.notice, self.side, self.form, self.script])())
        if self.r.random() < strange:
            parts.append(self.talk())
        return "".join(parts)

    def page(self) -> str:
        r = self.r
        inner = self.article(r.choice([0.0, 0.0, 0.12]))
        how = r.randint(0, 9)
        if how < 3:
            body = self.bare("article", inner, "content")
        elif how == 3:
            body = f"<main>{self.bare('article', inner, 'content')}</main>" if r.random() < 0.5 else self.bare("main", inner, "content")
        elif how < 7:
            body = self.named(r.choice(["div", "section"]), _ARTICLE, inner, "content")
        elif how == 7:
            body = f'<div>{self.bare("div", inner, "content")}</div>'
        elif how == 8:
            body = f'<table><tr>{self.bare("td", inner, "content")}</tr></table>'
        else:
            body = f'<div class="wrapper"><div class="row">{self.bare("section", inner, "content")}</div></div>'
        before = [f for f, p in ((self.head, 0.5), (self.menu, 0.8), (self.notice, 0.3), (self.advert, 0.5), (self.script, 0.3))
                  if r.random() < p]
        after = [f for f, p in ((self.side, 0.4), (self.talk, 0.35), (self.form, 0.25), (self.advert, 0.2), (self.notice, 0.15),
                                (self.foot, 0.85), (self.script, 0.2)) if r.random() < p]
        html = "".join(f() for f in before) + body + "".join(f() for f in after)
        if r.random() < 0.3:
            html = f'<div class="{r.choice(["container", "page", "wrap", "site"])}">{html}</div>'
        title = self.words(2, 6)
        return (f'<!DOCTYPE html><html><head><meta charset="utf-8"><title>{title}</title>'
                f"<style>p{{margin:0}}</style></head><body>{html}" + ("</body></html>" if r.random() < 0.9 else ""))


def labelled_pages(count: int = 200, seed: int = 7) -> list[str]:
    """``count`` labelled pages, the same for the same seed."""
    return [_Writer(seed * 1_000_003 + i).page() for i in range(count)]
