"""Labelled pages that the extraction model is trained on.

Pages are composed from layouts of invented words. Regions carry ``data-y``: 1 for the
article, 0 for everything around it; the parser hands it on to what the region holds.
The number of pages is a parameter, so training is bounded whatever is extracted.
"""

from __future__ import annotations

import random

TRAINING_PAGES = 300

# Names that page authors give to regions around the article, by kind.
AROUND = {
    "menu": "nav menu navbar navigation topnav mainmenu breadcrumb breadcrumbs tabs",
    "head": "header masthead site-header topbar logo branding",
    "foot": "footer site-footer colophon copyright legal bottom",
    "side": "sidebar aside widget rail related recommended popular trending tags",
    "advert": "ad ads advert advertisement banner sponsor sponsored promo promotion adsbygoogle",
    "notice": "cookie cookies consent notice gdpr popup modal overlay alert newsletter subscribe",
    "form": "form login search signup contact feedback",
    "comment": "comments comment comment-list discussion replies responses disqus respond",
    "share": "share social share-buttons toolbar pagination pager meta byline",
}
# Names of regions that hold the article.
ARTICLE = "content article post entry story main article-body post-content entry-content story-body page-content text"


class _Writer:
    def __init__(self, seed: int):
        self.random = random.Random(seed)

    def pick(self, text: str) -> str:
        return self.random.choice(text.split())

    def word(self) -> str:
        return "".join(self.pick("an er th on re ed in ou ti at el la de un ge ver sch ción ment") for _ in range(self.random.randint(1, 4)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.random.randint(low, high)))

    def sentence(self) -> str:
        return self.words(3, 18).capitalize() + self.random.choice([".", ".", ".", "?", "!"])

    def prose(self) -> str:
        count = self.random.choice([1, 1, 2, 3, 4, 6, 9])
        text = " ".join(self.sentence() for _ in range(count)) if self.random.random() < 0.9 else self.words(1, 6) + "."
        if self.random.random() < 0.15:
            text += f' <a href="/{self.word()}">{self.words(1, 4)}</a> {self.words(2, 8)}.'
        if self.random.random() < 0.15:
            text = f"<b>{self.words(1, 5)}</b> " + text
        return text

    # -- the article

    def article_block(self) -> str:
        kind = self.random.random()
        if kind < 0.72:
            return f"<p>{self.prose()}</p>"
        if kind < 0.8:
            level = self.random.randint(2, 4)
            return f"<h{level}>{self.words(1, 7)}</h{level}>"
        if kind < 0.87:
            tag = self.random.choice(["ul", "ol"])
            return f"<{tag}>" + "".join(f"<li>{self.prose()}</li>" for _ in range(self.random.randint(2, 5))) + f"</{tag}>"
        if kind < 0.91:
            return f"<blockquote><p>{self.prose()}</p></blockquote>"
        if kind < 0.94:
            row = lambda: "<tr>" + "".join(f"<td>{self.words(1, 4)}</td>" for _ in range(3)) + "</tr>"
            return "<table>" + row() + row() + "</table>"
        if kind < 0.97:
            return f"<pre>{self.words(3, 20)}</pre>"
        return f"<figure><figcaption>{self.words(3, 9)}</figcaption></figure>"

    def article(self) -> str:
        blocks = [self.article_block() for _ in range(self.random.randint(1, 14))]
        if self.random.random() < 0.3:
            # Some of the blocks in sections of their own.
            cut = self.random.randrange(len(blocks))
            tag = self.random.choice(["section", "div"])
            blocks[cut:] = [f"<{tag}>" + "".join(blocks[cut:]) + f"</{tag}>"]
        if self.random.random() < 0.6:
            # Something that is not the article inside the article's region.
            for _ in range(self.random.randint(1, 2)):
                kind = self.random.choice("advert share form notice side comment foot menu".split())
                blocks.insert(self.random.randint(0, len(blocks)), self.around(kind))
        body = "".join(blocks)
        title = f"<h1>{self.words(1, 9)}</h1>" if self.random.random() < 0.85 else ""
        if title and self.random.random() < 0.2:
            title = f"<header>{title}</header>"
        shape = self.random.random()
        if shape < 0.4:
            return f'<article data-y="1">{title}{body}</article>'
        if shape < 0.55:
            return f'<main data-y="1">{title}<div class="{self.pick(ARTICLE)}">{body}</div></main>'
        if shape < 0.9:
            return f'<div data-y="1" {self.random.choice(["class", "id"])}="{self.pick(ARTICLE)}">{title}{body}</div>'
        return f'<div data-y="1">{title}{body}</div>'

    # -- what stands around it

    def links(self, low: int, high: int) -> str:
        return "".join(f'<li><a href="/{self.word()}">{self.words(1, 3)}</a></li>' for _ in range(self.random.randint(low, high)))

    def named(self, kind: str) -> str:
        return f'{self.random.choice(["class", "class", "id"])}="{self.pick(AROUND[kind])}"'

    def around(self, kind: str) -> str:
        r = self.random
        text = " ".join(self.sentence() for _ in range(r.randint(1, 4)))
        if kind == "menu":
            tag = r.choice(["nav", "nav", "div", "ul"])
            inner = self.links(3, 9)
            inner = inner if tag == "ul" else f"<ul>{inner}</ul>"
            return f'<{tag} data-y="0" {"" if tag == "nav" and r.random() < 0.6 else self.named(kind)}>{inner}</{tag}>'
        if kind == "head":
            tag = r.choice(["header", "header", "div"])
            return f'<{tag} data-y="0" {self.named(kind)}><p>{self.words(1, 8)}</p><a href="/">{self.words(1, 3)}</a></{tag}>'
        if kind == "foot":
            tag = r.choice(["footer", "footer", "footer", "div"])
            inner = r.choice([f"&copy; {self.words(1, 4)} &middot; {text}", f"<p>&copy; 2024 {self.words(1, 6)}</p><ul>{self.links(1, 4)}</ul>", text])
            return f'<{tag} data-y="0" {"" if tag == "footer" and r.random() < 0.6 else self.named(kind)}>{inner}</{tag}>'
        if kind == "side":
            tag = r.choice(["aside", "aside", "div"])
            inner = r.choice([f"<h3>{self.words(1, 3)}</h3><ul>{self.links(2, 6)}</ul>", f"<p>{text}</p>", text])
            return f'<{tag} data-y="0" {"" if tag == "aside" and r.random() < 0.5 else self.named(kind)}>{inner}</{tag}>'
        if kind == "form":
            fields = f'<label>{self.words(1, 3)}</label><input name="q"><button>{self.words(1, 2)}</button>'
            return f'<form data-y="0" {self.named(kind) if r.random() < 0.5 else ""}>{r.choice(["", f"<p>{self.words(2, 9)}</p>"])}{fields}</form>'
        if kind == "comment":
            tag = r.choice(["section", "div", "div", "ol"])
            one = lambda: f'<div class="{r.choice(["comment", "comment-body", "reply"])}"><p>{text}</p><p>{self.words(1, 3)}</p></div>'
            return f'<{tag} data-y="0" {self.named(kind)}><h3>{self.words(1, 3)}</h3>{"".join(one() for _ in range(r.randint(1, 4)))}</{tag}>'
        inner = r.choice([text, f"<p>{text}</p>", f'<p>{text}</p><button>{self.words(1, 2)}</button>', f'<a href="/x">{self.words(2, 8)}</a>'])
        tag = r.choice(["div", "div", "section", "aside"])
        return f'<{tag} data-y="0" {self.named(kind)}>{inner}</{tag}>'

    def page(self) -> str:
        r = self.random
        tops = [self.around(k) for k in ("notice", "head", "menu", "advert", "share") if r.random() < 0.5]
        ends = [self.around(k) for k in ("share", "comment", "side", "advert", "form", "menu", "notice", "foot") if r.random() < 0.45]
        r.shuffle(tops)
        middle = self.article()
        body = "".join(tops) + middle + "".join(ends)
        for wrapper in r.choice([[], [], ["div"], ["div", "div"], ["form"]]):
            body = f'<{wrapper} class="{r.choice(["wrapper", "container", "page", "row", "layout"])}">{body}</{wrapper}>'
        return f"<html><head><title>{self.words(1, 5)}</title></head><body>{body}</body></html>"


def labelled_pages(count: int = TRAINING_PAGES, seed: int = 7) -> list[str]:
    return [_Writer(seed * 1_000_003 + i).page() for i in range(count)]
