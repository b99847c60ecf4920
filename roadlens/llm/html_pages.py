"""Generated web pages with known main text, on which the block labeller is fitted."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

_SYLLABLES = "an be co da el fi ga ho in ju ke lo ma ne or pa qui ra se ti un ve wa xo ya zu th er st sch eau ción é ü ñ".split()
#: Names that sites give to what surrounds an article, and to the article.
_AROUND = {
    "menu": "nav menu navbar navigation topnav mainmenu breadcrumb breadcrumbs toc links tabs pager pagination portlet navbox".split(),
    "header": "header masthead banner topbar branding logo siteheader tagline".split(),
    "footer": "footer bottom copyright colophon legal foot sitefooter credits printfooter imprint".split(),
    "side": "sidebar aside related widget recommended popular trending rail sidecol more archive tags categories catlinks".split(),
    "notice": "cookie consent notice gdpr alert popup modal overlay privacy warning disclaimer toast announcement".split(),
    "advert": "ad ads advert advertisement sponsor sponsored promo banner adsense advertising commercial".split(),
    "form": "form search newsletter subscribe login signup contact register".split(),
    "talk": "comments comment reply replies discussion respond disqus thread commentlist reviews feedback".split(),
    "share": "share social follow sharing meta byline author date tools print".split(),
}
_WITHIN = "article content main post entry story body text page maincontent entrycontent articlebody postcontent storybody prose bodycontent document parser output".split()
#: Names that tell nothing of what they hold: some sites give these to everything.
_NEUTRAL = "box wrap inner row col grid flex css item unit cell block group layer panel mx px mb text bg p m x1 a1 b2 c3 container section area".split()


def _words(rng: np.random.Generator, n: int) -> str:
    made = ["".join(rng.choice(_SYLLABLES, rng.integers(1, 4))) for _ in range(max(1, n))]
    marks = rng.random(len(made))
    noise = ["***", "&amp;", "%%", "!!", " |"][rng.integers(5)] if rng.random() < 0.12 else ""
    return " ".join(w + ("," if m < 0.08 else "." if m < 0.16 else noise if m < 0.7 else "") for w, m in zip(made, marks, strict=True)).capitalize() + ("." if rng.random() < 0.8 else "")


def _name(rng: np.random.Generator, names: list[str]) -> str:
    own = str(rng.choice(names))
    form = rng.integers(5)
    extra = str(rng.choice(["box", "wrap", "area", "left", "1", "list", "block", "container", "section", "inner"]))
    return [own, own, f"{own}-{extra}", f"{own}_{extra}", f"site-{own}"][form]


def _wrap(rng: np.random.Generator, tag: str, names: list[str] | None, inner: str) -> str:
    if names is None:
        return f"<{tag}>{inner}</{tag}>"
    kind = ["class", "id"][rng.integers(2)]
    return f'<{tag} {kind}="{_name(rng, names)}">{inner}</{tag}>'


def made_page(rng: np.random.Generator) -> tuple[str, Callable[[str], bool]]:
    """(html, a function that tells whether a block's text is main text)."""
    main: set[str] = set()
    plain = rng.random() < 0.22  # no name on the page tells what it holds
    within = _NEUTRAL if plain else _WITHIN
    styled = rng.random() < (0.6 if plain else 0.2)  # the text's own elements have classes, by size and space

    def style() -> str:
        return f' class="{" ".join(f"{rng.choice(_NEUTRAL)}-{rng.integers(1, 9)}" for _ in range(int(rng.integers(1, 4))))}"' if styled and rng.random() < 0.8 else ""

    def body_text(low: int, high: int) -> str:
        t = _words(rng, int(rng.integers(low, high)))
        main.add(" ".join(t.replace("&amp;", "&").split()))
        words = t.split(" ")
        for _ in range(int(rng.integers(0, 3)) if len(words) > 8 and rng.random() < 0.3 else 0):  # a link or a bold word within a line
            k, tag = int(rng.integers(0, len(words))), ["a href='/w'", "b", "em"][rng.integers(3)]
            if "<" not in words[k]:
                words[k] = f"<{tag}>{words[k]}</{tag.split()[0]}>"
        return " ".join(words)

    def link_line(n: int) -> str:
        between = [" | ", " ", " &middot; ", "<br>"][rng.integers(4)]
        return between.join(f'<a href="/{i}">{_words(rng, int(rng.integers(1, 3)))}</a>' for i in range(n))

    def links(n: int) -> str:
        return f"<ul{style()}>" + "".join(f'<li><a{style()} href="/{i}">{_words(rng, int(rng.integers(1, 4)))}</a></li>' for i in range(n)) + "</ul>"

    def paragraph(low: int, high: int) -> str:
        return f"<p>{_words(rng, int(rng.integers(low, high)))}</p>"

    def around(kind: str) -> str:
        names = _AROUND[kind] if rng.random() < 0.9 else None
        n = int(rng.integers(2, 9))
        if plain:  # links, a short line about rights or a form: what can be told without names
            inner = [links(n), link_line(n), f"<p>&copy; {_words(rng, 3)}</p>" + link_line(2)][2 if kind == "footer" else rng.integers(2)]
            if kind == "form":
                inner = f"<label>{_words(rng, 2)}</label><input type='text'><button>{_words(rng, 1)}</button>"
            return _wrap(rng, ["div", "div", "section", "nav" if kind == "menu" else "footer" if kind == "footer" else "div"][rng.integers(4)], _NEUTRAL, inner)
        if kind == "menu":
            if rng.random() < 0.25:
                return _wrap(rng, ["div", "p", "nav", "td"][rng.integers(3)], names, link_line(n))
            tag = "nav" if names is None or rng.random() < 0.6 else "div"
            return _wrap(rng, tag, None if tag == "nav" and rng.random() < 0.6 else names, links(n))
        if kind == "header":
            tag = "header" if names is None or rng.random() < 0.6 else "div"
            return _wrap(rng, tag, None if tag == "header" and rng.random() < 0.6 else names, (f"<a href='/'>{_words(rng, 2)}</a>" if rng.random() < 0.5 else paragraph(1, 8)) + (links(n) if rng.random() < 0.3 else ""))
        if kind == "footer":
            tag = "footer" if names is None or rng.random() < 0.6 else "div"
            inner = [f"&copy; {_words(rng, 3)} &middot; {_words(rng, int(rng.integers(2, 25)))}", paragraph(3, 30), links(n)][rng.integers(3)]
            return _wrap(rng, tag, None if tag == "footer" and rng.random() < 0.6 else names, inner)
        if kind == "side":
            tag = "aside" if names is None or rng.random() < 0.5 else "div"
            inner = f"<h3>{_words(rng, 2)}</h3>" + [links(n), paragraph(4, 40), paragraph(4, 20) + links(3)][rng.integers(3)]
            return _wrap(rng, tag, None if tag == "aside" and rng.random() < 0.6 else names, inner)
        if kind == "form":
            inner = f"<label>{_words(rng, 2)}</label><input type='text'><select><option>{_words(rng, 1)}</option><option>{_words(rng, 1)}</option></select><button>{_words(rng, 1)}</button>"
            return _wrap(rng, "form", names if rng.random() < 0.5 else None, inner + (paragraph(3, 20) if rng.random() < 0.4 else ""))
        if kind == "talk":
            each = "".join(_wrap(rng, ["div", "li", "article"][rng.integers(3)], _AROUND["talk"], paragraph(3, 60) if rng.random() < 0.7 else _words(rng, 15)) for _ in range(int(rng.integers(1, 6))))
            return _wrap(rng, ["section", "div", "ol"][rng.integers(3)], _AROUND["talk"], (f"<h2>{_words(rng, 2)}</h2>" if rng.random() < 0.5 else "") + each)
        inner = [paragraph(3, 30), _words(rng, int(rng.integers(2, 30))), f"<span>{_words(rng, 6)}</span> <a href='#'>{_words(rng, 2)}</a>"][rng.integers(3)]
        return _wrap(rng, ["div", "div", "section", "p" if not inner.startswith("<p") else "div"][rng.integers(4)], _AROUND[kind], inner)

    title = _words(rng, int(rng.integers(3, 12)))
    parts = []
    if rng.random() < 0.85:
        parts.append(f"<h1{style()}>{title}</h1>")
        main.add(" ".join(title.replace("&amp;", "&").split()))
    broken = rng.random() < 0.4
    for _ in range(int(rng.choice([1, 2, 3, 5, 8, 14, 25], p=[0.14, 0.14, 0.2, 0.2, 0.16, 0.1, 0.06]))):
        form = rng.random()
        if form < 0.62:
            parts.append(f"<p{style()}>{body_text(1, 90 if rng.random() < 0.85 else 4)}</p>")
        elif form < 0.74 and broken:
            parts.append(f"<p><b>{body_text(1, 60)}<br><p>{body_text(1, 60)}</p>")
        elif form < 0.8:
            parts.append(f"<h2{style()}>{body_text(1, 8)}</h2>")
        elif form < 0.86:
            parts.append("<ul>" + "".join(f"<li>{body_text(2, 20)}</li>" for _ in range(int(rng.integers(1, 5)))) + "</ul>")
        elif form < 0.9:
            parts.append(f"<blockquote><p>{body_text(4, 40)}</p></blockquote>")
        elif form < 0.94:
            parts.append("<table><tr>" + "".join(f"<td>{body_text(1, 6)}</td>" for _ in range(3)) + "</tr></table>")
        else:
            parts.append(f"<pre>{body_text(3, 30)}</pre>")
    for kind in ("advert", "share", "side", "form", "notice", "menu"):
        if rng.random() < 0.1:
            parts.insert(int(rng.integers(1, len(parts) + 1)), around(kind))
    if rng.random() < 0.08:
        parts.append(around("talk"))
    shape = rng.random()
    inner = "".join(parts)
    if shape < 0.55:
        core = _wrap(rng, "article", within if rng.random() < 0.3 else None, inner)
        if rng.random() < 0.3:
            core = _wrap(rng, ["main", "div"][rng.integers(2)], within if rng.random() < 0.5 else None, core)
    elif shape < 0.72:
        core = _wrap(rng, "main", within if rng.random() < 0.3 else None, inner)
    elif shape < 0.92:
        core = _wrap(rng, ["div", "section"][rng.integers(2)], within, inner)
        if rng.random() < 0.4:
            core = _wrap(rng, "div", within if rng.random() < 0.6 else None, core)
    else:
        core = inner
    before = [around(k) for k in ("header", "menu", "notice", "advert", "side", "form") if rng.random() < (0.5 if k in ("header", "menu", "advert") else 0.2)]
    after = [around(k) for k in ("talk", "side", "advert", "share", "form", "notice", "footer") if rng.random() < (0.7 if k == "footer" else 0.25)]
    rng.shuffle(before)
    head = f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{title if rng.random() < 0.6 else _words(rng, 5)}</title><style>p{{}}</style><script>var x='</p>';</script></head><body>"
    if rng.random() < 0.1:  # laid out by a table: what stands around in rows and columns of its own
        cell = lambda x, width="": f'<td valign="top"{width}>{x}</td>'
        rows = [f"<tr>{cell(x, ' colspan=2')}</tr>" for x in before]
        side = cell([links(4), link_line(5)][rng.integers(2)], " width=150") if rng.random() < 0.6 else ""
        rights = f"<font size=1>{['&copy;', 'Copyright'][rng.integers(2)]} {_words(rng, 4)}</font>" if rng.random() < 0.6 else ""
        rows += [f"<tr>{side}{cell(inner)}</tr>", *(f"<tr>{cell(x, ' colspan=2')}</tr>" for x in after), f"<tr>{cell(rights, ' align=center')}</tr>" if rights else ""]
        before, core, after = [], f'<table width="100%">{"".join(rows)}</table>', []
    page = head + "".join(before) + core + "".join(after) + ("</body></html>" if rng.random() < 0.9 else "")

    seen_title = [0]
    in_head = f"<title>{title}</title>" in page
    whole = " ".join(title.replace("&amp;", "&").split())

    def wanted(text: str) -> bool:
        if text == whole and in_head:  # the head's title stands first and is not main text
            seen_title[0] += 1
            return seen_title[0] > 1 and text in main
        return text in main

    return page, wanted
