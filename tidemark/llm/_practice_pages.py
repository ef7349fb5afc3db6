"""Made-up pages with known main text, on which the extractor is trained."""

from __future__ import annotations

import random

#: Stands before every word of main text; taken out again before features are computed.
MARK = "\ue000"
_SYLLABLES = "al an ar be co de en er es ha in is la le ma mi no on or ra re ri sa se st ta te th ti to un ve".split()


class PageMaker:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choices(_SYLLABLES, k=self.r.choice((1, 1, 2, 2, 3))))

    def words(self, low: int, high: int, main: bool = False) -> str:
        mark = MARK if main else ""
        out = [mark + self.word() for _ in range(self.r.randint(low, high))]
        for i in range(len(out)):
            if self.r.random() < 0.12:
                out[i] += self.r.choice((".", ",", ".", "&amp;"))
        return " ".join(out) + self.r.choice((".", ".", ""))

    def name(self, *choices: str) -> str:
        picked = self.r.choice(choices)
        if not picked:
            return ""
        style = self.r.choice(("class", "class", "id"))
        suffix = self.r.choice(("", "", "-wrap", " box", "__inner", "_1"))
        return f' {style}="{picked}{suffix}"'

    def links(self, low: int, high: int) -> str:
        items = [f'<li><a href="/{self.word()}">{self.words(1, 3)}</a></li>' for _ in range(self.r.randint(low, high))]
        return "<ul>" + "".join(items) + "</ul>"

    def nav(self) -> str:
        tag = self.r.choice(("nav", "nav", "div"))
        name = self.name("nav", "menu", "navigation", "breadcrumbs", "main-menu") if tag == "div" else self.name("", "", "menu", "nav")
        return f"<{tag}{name}>{self.links(3, 9)}</{tag}>"

    def noise(self) -> str:
        r = self.r
        kind = r.randrange(9)
        if kind == 0:
            return f'<div{self.name("ad", "ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner-ad")}>{self.words(3, 30)}</div>'
        if kind == 1:
            tag = r.choice(("aside", "aside", "div"))
            name = self.name("sidebar", "side-bar", "widget", "right-rail") if tag == "div" else self.name("", "sidebar", "widget")
            inner = f"<h3>{self.words(1, 4)}</h3>" + r.choice((self.links(3, 8), f"<p>{self.words(8, 50)}</p>"))
            return f"<{tag}{name}>{inner}</{tag}>"
        if kind == 2:
            return f'<div{self.name("cookie-notice", "cookie-consent", "notice", "alert", "gdpr-banner", "popup")}><p>{self.words(8, 35)}</p><button>{self.words(1, 2)}</button></div>'
        if kind == 3:
            return f'<form{self.name("", "newsletter", "search", "login")} action="/s"><label>{self.words(1, 5)}</label><input type="text">{r.choice(("", f"<p>{self.words(4, 15)}</p>"))}<button>{self.words(1, 2)}</button></form>'
        if kind == 4:
            return f'<div{self.name("related", "more-stories", "recommended", "popular", "tags")}><h3>{self.words(1, 4)}</h3>{self.links(3, 7)}</div>'
        if kind == 5:
            return f'<div{self.name("share", "social", "follow-us")}>{self.links(2, 5)}</div>'
        return self.comments() if kind == 6 else r.choice((self.nav(), f'<div{self.name("ad", "ads", "advert")}>{self.words(4, 30)}</div>'))

    def comments(self) -> str:
        r = self.r
        tag, one = r.choice(("section", "div", "div")), r.choice(("div", "article", "li"))
        body = "".join(f'<{one}{self.name("comment", "comment", "reply", "comment-body")}><b>{self.word()}</b><p>{self.words(5, 70)}</p></{one}>' for _ in range(r.randint(1, 7)))
        return f'<{tag}{self.name("comments", "comment-list", "discussion", "comments-area")}><h3>{self.words(1, 3)}</h3>{body}</{tag}>'

    def paragraph(self) -> str:
        r = self.r
        text = self.words(*r.choice(((1, 6), (5, 25), (15, 90), (30, 150))), main=True)
        if r.random() < 0.15:
            text = f"<b>{text}" + r.choice(("</b>", "", "<br>"))
        if r.random() < 0.1:
            text += f' <a href="/x">{self.words(1, 4, main=True)}</a>'
        tag = r.choice(("p",) * 9 + ("div",))
        return f"<{tag}>{text}" + (f"</{tag}>" if tag == "div" or r.random() < 0.85 else "")

    def main(self, bare: bool) -> str:
        r = self.r
        out = [f"<h1>{self.words(2, 10, main=True)}</h1>"] if r.random() < 0.8 else []
        for _ in range(r.choice((0, 1, 2, 3, 5, 8, 13, 20))):
            x = r.random()
            if x < 0.70:
                out.append(self.paragraph())
            elif x < 0.78:
                out.append(f"<h2>{self.words(2, 7, main=True)}</h2>")
            elif x < 0.84:
                out.append("<ul>" + "".join(f"<li>{self.words(3, 20, main=True)}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif x < 0.88:
                out.append(f"<blockquote><p>{self.words(8, 40, main=True)}</p></blockquote>")
            elif not bare:
                out.append(self.noise())
        if not out:
            out.append(self.paragraph())
        return "".join(out)

    def page(self) -> str:
        r = self.r
        bare = r.random() < 0.5
        body = self.main(bare)
        wrap = r.choice(("article", "article", "article", "main", "div", "section"))
        name = self.name("content", "post", "entry-content", "article-body", "story", "main-text", "") if wrap in ("div", "section") else self.name("", "", "post", "article")
        body = f"<{wrap}{name}>{body}"
        if not bare and r.random() < 0.6:
            body += r.choice((self.comments, self.noise))()
        body += f"</{wrap}>"
        if r.random() < 0.3:
            body = f'<div{self.name("", "wrapper", "page", "container", "content")}>{body}</div>'
        before = [] if r.random() < 0.1 else [self.nav()]
        if not bare or r.random() < 0.3:
            tag = r.choice(("header", "div"))
            name = self.name("header", "masthead", "top-bar") if tag == "div" else self.name("", "site-header")
            before.insert(0, f"<{tag}{name}><h1>{self.words(1, 4)}</h1><p>{self.words(2, 12)}</p></{tag}>")
        before += [self.noise() for _ in range(r.choice((0, 0, 1, 1, 2)))]
        if bare and r.random() < 0.7:
            before.append(f'<!-- ad --><div class="ad">{self.words(3, 14)}</div>')
        after = [] if bare else [self.noise() for _ in range(r.choice((0, 1, 2, 3)))]
        if r.random() < 0.9:
            tag = r.choice(("footer", "footer", "div"))
            name = self.name("footer", "site-footer", "copyright") if tag == "div" else self.name("", "footer")
            after.append(f"<{tag}{name}>&copy; {self.words(2, 20)}</{tag}>")
        end = "</body></html>" if r.random() < 0.9 else ""
        return f"<html><head><title>{self.words(2, 8)}</title><style>p{{margin:0}}</style></head><body>{''.join(before)}{body}{''.join(after)}{end}"
