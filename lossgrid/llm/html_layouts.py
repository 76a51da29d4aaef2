"""Labelled pages to learn extraction from: layouts with known roles, filled with sentences of the corpus.

A layout is a random page skeleton: a header, menus, side columns, notices, adverts, forms, reader comments and a footer
around (and inside) one article. Names and elements of each part are drawn from the customary ones, or left out or made
meaningless, so that a model cannot lean on names alone. The part that is the article carries ``data-mark="c"``, parts
inside it that are not carry ``data-mark="x"``; the model never sees the mark.
"""

from __future__ import annotations

import html
import random
from collections.abc import Sequence

# Customary names of page parts (fixed values).
CONTENT = (
    "article post entry content story main text body article-body post-content entry-content story-body article-content main-content "
    "page-content blog-post news-text single-post article__body post-body hentry prose reading longform"
).split()
WRAPPER = "page wrapper wrap container outer site layout root app row inner grid col holder columns".split()
MENU = "nav menu navbar navigation main-menu topnav site-nav breadcrumb breadcrumbs pagination tabs toolbar nav-links sitemap".split()
HEADER = "header masthead site-header top banner-top logo branding page-header topbar".split()
FOOTER = "footer site-footer bottom copyright legal colophon foot footer-links imprint".split()
SIDE = "sidebar aside side widget widgets rail secondary related related-posts popular trending recent most-read tags archive".split()
NOTICE = "notice cookie cookies consent cookie-banner alert gdpr privacy-notice disclaimer paywall popup modal message announcement".split()
ADVERT = "ad ads advert advertisement sponsored sponsor promo promotion banner-ad adsbox ad-slot teaser-ad dfp commercial".split()
FORM = "newsletter subscribe signup login search contact-form subscription register search-box poll survey".split()
COMMENTS = "comments comment comment-list responses discussion disqus replies reader-comments feedback comment-thread reviews".split()
SHARE = "share social share-buttons social-links follow sharing toolbox author-links".split()


class _Writer:
    def __init__(self, draw: random.Random, sentences: Sequence[str]):
        self.draw, self.sentences = draw, sentences
        self.named = draw.random() < 0.8  # whether this page's parts bear customary names
        self.semantic = draw.random() < 0.65  # whether it uses the elements meant for its parts

    def sentence(self) -> str:
        return self.draw.choice(self.sentences)

    def words(self, n: int) -> str:
        return " ".join(self.sentence().split()[:n]) or "more"

    def prose(self, n: int) -> str:
        return " ".join(self.sentence() for _ in range(n))

    def attributes(self, names: Sequence[str], chance: float = 0.85) -> str:
        draw = self.draw
        if self.named and draw.random() < chance:
            name = draw.choice(names)
        elif draw.random() < 0.4:
            name = "".join(draw.choice("bcdfghjklmnpqrstvwxz") for _ in range(6))
        else:
            return ""
        return f' {draw.choice(("class", "class", "id"))}="{name}"'

    def element(self, tags: Sequence[str], names: Sequence[str], inner: str, mark: str = "") -> str:
        tag = tags[0] if self.semantic else self.draw.choice(tags[1:] or tags)
        mark = f' data-mark="{mark}"' if mark else ""
        named = self.attributes(names, 0.35 if tag not in ("div", "section", "td", "ul") else 0.85)
        return f"<{tag}{named}{mark}>{inner}</{tag}>"

    def links(self, n: int, words: int = 2) -> str:
        draw = self.draw
        each = [f'<a href="/{i}">{html.escape(self.words(draw.randint(1, words)))}</a>' for i in range(n)]
        if draw.random() < 0.7:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in each) + "</ul>"
        return draw.choice((" | ", " ", " &middot; ", "<br>")).join(each)

    def menu(self) -> str:
        return self.element(("nav", "div", "ul"), MENU, self.links(self.draw.randint(2, 12)))

    def header(self) -> str:
        title = f"<h1>{html.escape(self.words(3))}</h1>" if self.draw.random() < 0.3 else html.escape(self.words(4))
        return self.element(("header", "div"), HEADER, title + (self.menu() if self.draw.random() < 0.5 else ""))

    def footer(self) -> str:
        inner = f"&copy; {html.escape(self.words(3))} &middot; {html.escape(self.sentence())}"
        if self.draw.random() < 0.4:
            inner = f"<p>{inner}</p>" + self.links(self.draw.randint(2, 8))
        return self.element(("footer", "div"), FOOTER, inner)

    def side(self) -> str:
        draw = self.draw
        parts = [f"<h3>{html.escape(self.words(3))}</h3>" + self.links(draw.randint(3, 10), 8) for _ in range(draw.randint(1, 3))]
        if draw.random() < 0.4:
            parts.append(f"<p>{html.escape(self.prose(draw.randint(1, 2)))}</p>")
        return self.element(("aside", "div"), SIDE, "".join(parts))

    def notice(self, mark: str = "") -> str:
        inner = html.escape(self.prose(self.draw.randint(1, 2)))
        inner = f"<p>{inner}</p>" if self.draw.random() < 0.5 else inner
        return self.element(("div", "div", "section"), NOTICE, inner + (" <button>OK</button>" if self.draw.random() < 0.5 else ""), mark)

    def advert(self, mark: str = "") -> str:
        inner = html.escape(self.prose(self.draw.randint(1, 2)))
        if self.draw.random() < 0.4:
            inner = f'<a href="/buy"><img src="x.png">{inner}</a>'
        return self.element(("div", "div", "aside", "p"), ADVERT, inner, mark)

    def form(self, mark: str = "") -> str:
        fields = "".join(f'<label>{html.escape(self.words(2))}</label><input name="f{i}">' for i in range(self.draw.randint(1, 4)))
        inner = f"<p>{html.escape(self.sentence())}</p>{fields}<button>{html.escape(self.words(1))}</button>"
        return self.element(("form", "form"), FORM, inner, mark)

    def share(self, mark: str = "") -> str:
        return self.element(("div", "ul"), SHARE, self.links(self.draw.randint(2, 6), 1), mark)

    def comments(self, mark: str = "") -> str:
        each = []
        for _ in range(self.draw.randint(1, 6)):
            head = f"<span>{html.escape(self.words(2))}</span>"
            text = html.escape(self.prose(self.draw.randint(1, 4)))
            each.append(self.element(("div", "li", "article"), COMMENTS[:2], f"{head}<p>{text}</p>" + ('<a href="#r">reply</a>' if self.draw.random() < 0.5 else "")))
        head = f"<h3>{html.escape(self.words(2))}</h3>" if self.draw.random() < 0.7 else ""
        return self.element(("section", "div"), COMMENTS, head + "".join(each) + (self.form() if self.draw.random() < 0.4 else ""), mark)

    def article(self) -> str:
        draw = self.draw
        blocks = [f"<h1>{html.escape(self.words(draw.randint(2, 9)))}</h1>"] if draw.random() < 0.7 else []
        breaks = draw.random() < 0.1
        for _ in range(draw.choice((0, 1, 1, 2, 3, 5, 8, 13, 20))):
            kind = draw.random()
            n = draw.choice((1, 1, 2, 3, 5, 9))
            text = html.escape(self.prose(n))
            if draw.random() < 0.2:
                text = f"<b>{text}<br>" if draw.random() < 0.5 else f"{text} <a href='/q'>{html.escape(self.words(2))}</a> <i>{html.escape(self.words(3))}</i>"
            if breaks:
                blocks.append(text + "<br><br>")
            elif kind < 0.78:
                blocks.append(f"<p>{text}</p>" if draw.random() < 0.85 else f"<p>{text}")
            elif kind < 0.84:
                blocks.append(f"<h2>{html.escape(self.words(5))}</h2>")
            elif kind < 0.89:
                blocks.append("<ul>" + "".join(f"<li>{html.escape(self.words(draw.randint(2, 15)))}</li>" for _ in range(draw.randint(2, 6))) + "</ul>")
            elif kind < 0.93:
                blocks.append(f"<blockquote><p>{text}</p></blockquote>")
            elif kind < 0.96:
                blocks.append("<table>" + "".join(f"<tr><td>{html.escape(self.words(2))}</td><td>{html.escape(self.words(3))}</td></tr>" for _ in range(3)) + "</table>")
            else:
                blocks.append(f"<div>{text}</div>")
        for part in (self.advert, self.share, self.notice, self.form):
            if draw.random() < 0.12:
                blocks.insert(draw.randint(0, len(blocks)), part(mark="x"))
        if draw.random() < 0.1:
            blocks.append(self.comments(mark="x"))
        if not blocks:
            blocks = [f"<h1>{html.escape(self.words(3))}</h1>"]
        return self.element(("article", "div", "div", "main", "section", "td"), CONTENT, "".join(blocks), "c")


def labelled_page(seed: int, sentences: Sequence[str]) -> str:
    """One page; the same for the same seed and sentences."""
    draw = random.Random(seed)
    w = _Writer(draw, sentences)
    if draw.random() < 0.03:  # plain text with line breaks
        return f'<div data-mark="c">{"<br>".join(html.escape(w.prose(2)) for _ in range(draw.randint(1, 6)))}</div>'
    before = [part() for part, chance in ((w.header, 0.5), (w.menu, 0.7), (w.notice, 0.25), (w.advert, 0.35), (w.form, 0.12), (w.side, 0.2)) if draw.random() < chance]
    after = [part() for part, chance in ((w.share, 0.25), (w.comments, 0.4), (w.side, 0.4), (w.advert, 0.2), (w.form, 0.15), (w.notice, 0.1)) if draw.random() < chance]
    if draw.random() < 0.3:
        draw.shuffle(before)
    middle = w.article()
    for _ in range(draw.choice((0, 0, 1, 1, 2, 3))):
        take = draw.randint(0, len(before))
        middle = w.element(("div", "div", "main", "section"), WRAPPER, "".join(before[take:]) + middle + "".join(after))
        before, after = before[:take], []
    foot = w.footer() if draw.random() < 0.8 else ""
    return f"<html><head><title>{html.escape(w.words(4))}</title></head><body>{''.join(before)}{middle}{''.join(after)}{foot}</body></html>"
