"""Pages whose blocks are labelled, made by rule, for training the extraction model.

A page is a nesting of parts.  Text inside a part marked as main is the article, all other text is not; markup,
class names, order and amount of text vary, so that no single sign decides.
"""

from __future__ import annotations

import random

SYLLABLES = "ba de fi ko lu mar ne sto pri ven tra gel hin or ush ain est oul per qua wi yo zen ck".split()
#: Names that sites use for their parts.
WRAPPERS = ["article", "main", "div.post", "div#content", "section.article-body", "div.entry-content", "div.story",
            "div.main-text", "td.content"]
MENUS = ["nav", "div.menu", "ul.nav-links", "div#navbar", "nav.breadcrumb", "div.pagination", "ul.tabs", "div.toolbar"]
HEADS = ["header", "div#header", "div.site-header", "div.masthead", "header.top", "div.topbar"]
FEET = ["footer", "div#footer", "div.site-footer", "footer.bottom", "div.copyright", "div.legal"]
SIDES = ["aside", "div.sidebar", "div#sidebar", "aside.widget", "div.related", "section.recommended", "div.teaser-list",
         "div.author-bio", "div.tags", "div.share", "div.social"]
NOTICES = ["div.notice", "div.cookie-banner", "div.alert", "div#consent", "p.disclaimer", "div.popup", "div.modal",
           "div.newsletter", "div.subscribe", "section.promo", "div.message"]
ADVERTS = ["div.ad", "div.advert", "div#ads", "div.sponsored", "aside.advertisement", "ins.adsbygoogle", "div.ad-slot",
           "section.sponsor", "div.banner"]
REMARKS = ["section.comments", "div#comments", "ol.comment-list", "div.reader-comments", "div.replies",
           "div.discussion", "section.responses"]
FORMS = ["form", "form.search", "div.login", "fieldset", "form.contact", "div.search-box"]


class Page:
    def __init__(self, seed: int):
        self.random = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        r = self.random
        out = ["".join(r.choices(SYLLABLES, k=r.randint(1, 4))) for _ in range(r.randint(low, high))]
        form = r.random()
        if form < 0.04:
            out = [w.upper() for w in out]
        elif form < 0.08:
            out = [out[0]] * len(out)
        elif form < 0.14:
            out.insert(r.randint(0, len(out)), r.choice(["2024", "+1 555 0101", "| x |", "a@b.example", "\u00a9 copyright", "10%"]))
        end = r.choice([".", ".", ".", "!", "", "", ":", ","])
        return (r.choice([" | ", "*** ", " "]) if form > 0.97 else " ").join(out).capitalize() + end

    def part(self, name: str, inner: str) -> str:
        tag, kind = name, ""
        if "." in name:
            tag, kind = name.split(".")
            kind = f' class="{kind}"' if self.random.random() < 0.8 else f' class="x1 {kind} col"'
        elif "#" in name:
            tag, kind = name.split("#")
            kind = f' id="{kind}"'
        return f"<{tag}{kind}>{inner}</{tag}>"

    def links(self, low: int, high: int) -> str:
        r = self.random
        items = [f'<a href="/{n}">{self.words(1, 4)}</a>' for n in range(r.randint(low, high))]
        return r.choice([lambda: "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>", lambda: " ".join(items),
                         lambda: "".join(f"<p>{i}</p>" for i in items)])()

    def other(self, kinds: list[str]) -> str:
        r = self.random
        prose = "".join(f"<p>{self.words(1, 45)}</p>" for _ in range(r.randint(1, 3)))
        inner = r.choice([self.links(1, 7), self.words(1, 30), prose, self.words(2, 9) + self.links(1, 4),
                          f"<h3>{self.words(1, 4)}</h3>{prose}"])
        return self.part(r.choice(kinds), inner)

    def remarks(self) -> str:
        r = self.random
        one = ["<div class='comment'><b>{}</b><p>{}</p></div>", "<article class='comment'><p>{}</p><p>{}</p></article>",
               "<li><p>{}</p><div>{}</div></li>", "<div><span class='author'>{}</span> {}</div>"]
        form = r.choice(one)
        found = "".join(form.format(self.words(1, 2), self.words(2, 50)) for _ in range(r.randint(1, 5)))
        return self.part(r.choice(REMARKS), f"<h3>{self.words(1, 3)}</h3>" * r.randint(0, 1) + found)

    def article(self) -> str:
        r, marked = self.random, []
        heading = f"<main-text><h1>{self.words(2, 10)}</h1></main-text>"
        for _ in range(r.randint(1, 9)):
            text = self.words(1, 70)
            if r.random() < 0.25:
                text = f'{text} <a href="/x">{self.words(1, 5)}</a> <em>{self.words(1, 3)}</em>'
            kind = r.random()
            made = (f"<p>{text}</p>" if kind < 0.65 else f"<h2>{self.words(1, 7)}</h2><p>{text}</p>" if kind < 0.75
                    else f"<ul><li>{text}</li><li>{self.words(1, 25)}</li></ul>" if kind < 0.82
                    else f"<blockquote>{text}</blockquote>" if kind < 0.87 else f"<div>{text}</div>" if kind < 0.93
                    else f"<p><b>{text}<br>" if kind < 0.97 else f"<pre>{text}</pre>")
            marked.append(f"<main-text>{made}</main-text>")
            if r.random() < 0.12:
                marked.append(self.other(r.choice([ADVERTS, SIDES, NOTICES])))
        tail = self.part(r.choice(["footer", "div.meta", "div.share"]), self.words(1, 6)) if r.random() < 0.15 else ""
        inner = heading * (r.random() < 0.85) + "".join(marked) + tail
        if r.random() < 0.2:
            inner += self.remarks()
        name = r.choice(["article"] * 4 + ["main"] * 3 + WRAPPERS)
        made = self.part(name, inner)
        if r.random() < 0.3:
            made = self.part(r.choice(["div.wrapper", "main", "div#page", "div.container", "section"]), made)
        return made

    def html(self) -> str:
        r = self.random
        before = [k for k in (HEADS, MENUS, NOTICES, ADVERTS, FORMS, SIDES) if r.random() < 0.5]
        after = [k for k in (SIDES, ADVERTS, NOTICES, FORMS, MENUS) if r.random() < 0.4]
        body = [self.other(k) for k in before] + [self.article()]
        if r.random() < 0.35:
            body.append(self.remarks())
        body += [self.other(k) for k in after]
        if r.random() < 0.7:
            body.append(self.other(FEET))
        return f"<html><head><title>{self.words(2, 6)}</title></head><body>{''.join(body)}</body></html>"


def labelled_pages(count: int) -> list[str]:
    """Pages in which ``<main-text>`` elements hold the main blocks."""
    return [Page(seed).html() for seed in range(count)]
