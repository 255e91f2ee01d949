"""Labelled pages to train on, made by rule: their main blocks lie in elements marked ``data-main``."""

from __future__ import annotations

import random

_SYLLABLES = "an be co du el fi ga hu in ja ko lu ma no os pe qui ra su te un vi wo xa yo za".split()


def labelled_pages(n: int, seed: int = 11) -> list[str]:
    """``n`` pages of many layouts: with and without semantic elements and telling names, with menus,
    notices, adverts, forms, sidebars, related links and comments around and inside the article."""
    rng = random.Random(seed)
    pick = rng.choice

    def word() -> str:
        return "".join(pick(_SYLLABLES) for _ in range(rng.randint(1, 3)))

    def words(lo: int, hi: int) -> str:
        return " ".join(word() for _ in range(rng.randint(lo, hi)))

    def sentence(lo: int = 3, hi: int = 18) -> str:
        parts = [words(lo, hi).capitalize()]
        if rng.random() < 0.4:
            parts.append(words(2, 8))
        return ", ".join(parts) + pick("...!?" if rng.random() < 0.1 else ".")

    def prose(lo: int = 1, hi: int = 6) -> str:
        text = " ".join(sentence() for _ in range(rng.randint(lo, hi)))
        if rng.random() < 0.15:
            k = text.find(" ")
            text = f'{text[:k]} <a href="/{word()}">{words(1, 3)}</a>{text[k:]}'
        if rng.random() < 0.1:
            text = f"<b>{text}<br>"
        return text

    def link(lo: int = 1, hi: int = 3) -> str:
        return f'<a href="/{word()}">{words(lo, hi)}</a>'

    def items(n_lo: int, n_hi: int, lo: int = 1, hi: int = 3) -> str:
        return "<ul>" + "".join(f"<li>{link(lo, hi)}</li>" for _ in range(rng.randint(n_lo, n_hi))) + "</ul>"

    def named(names: str) -> str:
        """An attribute with one of the names, or none."""
        if rng.random() < 0.2:
            return ""
        name = pick(names.split())
        return pick([f' class="{name}"', f' id="{name}"', f' class="{word()} {name}-{word()}"'])

    def menu() -> str:
        return pick([f"<nav>{items(3, 9)}</nav>", f"<div{named('menu nav navbar navigation')}>{items(3, 9)}</div>",
                     f"<nav{named('main-menu')}>{' | '.join(link() for _ in range(5))}</nav>", items(4, 8)])

    def header() -> str:
        name = pick([f"<h1>{words(1, 3)}</h1>", f"<div>{link()}</div>", f"<p>{words(2, 6)}</p>", f"<h2>{words(1, 3)}</h2>"])
        inner = name + (f"<p>{sentence(3, 7)}</p>" if rng.random() < 0.4 else "") + (menu() if rng.random() < 0.6 else "")
        return pick([f"<header>{inner}</header>", f'<div class="{pick(["header", "masthead", "top", "site-header", "branding"])}">{inner}</div>', menu()])

    def advert() -> str:
        inner = pick([sentence(), f"<p>{prose(1, 3)}</p>", link(2, 5), f"<h3>{words(2, 4)}</h3><p>{sentence()}</p>"])
        name = pick("ad ads advert advertisement sponsored promo ad-box ad-banner".split())
        return pick([f'<div class="{name}">{inner}</div>', f'<aside class="{name}">{inner}</aside>', f'<div id="{name}">{inner}</div>', f'<section class="{name}">{inner}</section>'])

    def notice() -> str:
        name = pick("notice cookie-notice cookie-consent gdpr alert popup message".split())
        inner = pick([f"<p>{prose(1, 2)}</p><button>{words(1, 2)}</button>", prose(1, 3), f"<p>{sentence()}</p>"])
        return pick([f'<div class="{name}">{inner}</div>', f'<section id="{name}">{inner}</section>', f'<div role="alert">{inner}</div>'])

    def form() -> str:
        fields = "".join(f"<label>{words(1, 2)}</label><input name={word()}>" for _ in range(rng.randint(1, 4)))
        intro = pick(["", f"<p>{sentence()}</p>", f"<h3>{words(2, 4)}</h3><p>{prose(1, 2)}</p>"])
        return f"<form{named('newsletter login subscribe search contact')}>{intro}{fields}<button>{word()}</button></form>"

    def sidebar() -> str:
        inner = "".join(pick([f"<h3>{words(1, 3)}</h3>{items(2, 6)}", f"<p>{prose(1, 3)}</p>", f"<h2>{words(1, 2)}</h2><p>{prose(1, 3)}</p>"]) for _ in range(rng.randint(1, 3)))
        return pick([f"<aside>{inner}</aside>", f"<aside{named('sidebar side widget')}>{inner}</aside>", f'<div class="{pick(["sidebar", "side", "widget", "right-column"])}">{inner}</div>'])

    def related() -> str:
        return f'<{(t := pick(["div", "section", "aside"]))} class="{pick(["related", "recommended", "more-stories", "also", "popular", "share", "social"])}"><h3>{words(1, 4)}</h3>{items(2, 6, 2, 6)}</{t}>'

    def comments() -> str:
        one = lambda: pick([f"<li><b>{word()}</b><p>{prose(1, 3)}</p></li>", f'<div class="comment"><p>{word()}</p><p>{prose(1, 3)}</p></div>', f"<p>{prose(1, 2)}</p>", f'<article class="comment"><p>{prose(1, 3)}</p></article>'])
        inner = f"<h3>{words(1, 3)}</h3>" + "".join(one() for _ in range(rng.randint(1, 5)))
        name = pick("comments comment-list discussion replies reader-comments".split())
        return pick([f'<section id="{name}">{inner}</section>', f'<div class="{name}">{inner}</div>', f'<ol class="{name}">{inner}</ol>', f'<section class="{name}">{inner}</section>'])

    def footer() -> str:
        inner = pick([f"&copy; {word()}.example {sentence(2, 6)}", f"<p>&copy; {words(2, 6)}</p>", f"{items(2, 5)}<p>{sentence(3, 9)}</p>", f"<p>{words(3, 8)} | {words(1, 3)}</p>"])
        return pick([f"<footer>{inner}</footer>", f'<div class="{pick(["footer", "bottom", "copyright", "site-footer"])}">{inner}</div>'])

    def article() -> str:
        parts = [f"<h1 data-main=1>{sentence(2, 9)}</h1>"] if rng.random() < 0.85 else []
        if parts and rng.random() < 0.2:
            parts = [f"<header>{parts[0]}</header>"]
        for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 14, 20])):
            kind = rng.random()
            if kind < 0.66:
                parts.append(f"<p data-main=1>{prose(1, pick([1, 3, 6, 10]))}" + ("</p>" if rng.random() < 0.9 else ""))
            elif kind < 0.74:
                level = pick("234")
                parts.append(f"<h{level} data-main=1>{words(1, 7)}</h{level}>")
            elif kind < 0.79:
                parts.append("<ul data-main=1>" + "".join(f"<li>{pick([sentence(), words(1, 6)])}</li>" for _ in range(rng.randint(2, 5))) + "</ul>")
            elif kind < 0.82:
                parts.append(f"<blockquote data-main=1>{pick([prose(1, 2), f'<p>{prose(1, 2)}</p>'])}</blockquote>")
            elif kind < 0.84:
                parts.append("<table data-main=1>" + "".join(f"<tr><td>{words(1, 3)}</td><td>{words(1, 3)}</td></tr>" for _ in range(3)) + "</table>")
            elif kind < 0.86:
                parts.append(f"<figure><img src=x><figcaption data-main=1>{sentence()}</figcaption></figure>")
            elif kind < 0.88:
                parts.append(f"<div data-main=1>{prose(1, 4)}</div>")
            else:
                parts.append(pick([advert, related, notice, form, sidebar, menu, comments])())
        inner = "".join(parts)
        shell = rng.random()
        if shell < 0.45:
            return f"<article{named('post entry story')}>{inner}</article>"
        if shell < 0.6:
            return f"<main>{pick([inner, f'<article>{inner}</article>', f'<section>{inner}</section>'])}</main>"
        if shell < 0.9:
            return f'<div class="{pick(["content", "post", "entry-content", "article-body", "story", "main-text", "page-content"])}">{inner}</div>'
        return f"<div>{inner}</div>"

    def page() -> str:
        before = [f() for f in (header, menu, notice, advert, form, sidebar) if rng.random() < 0.4]
        after = [f() for f in (advert, related, comments, sidebar, form, notice) if rng.random() < 0.4]
        rng.shuffle(before)
        rng.shuffle(after)
        body = "".join([*before, article(), *after, footer() if rng.random() < 0.85 else ""])
        if rng.random() < 0.3:
            body = f"<div id=page>{body}</div>"
        return f"<html><head><title>{words(1, 4)}</title></head><body>{body}</body></html>"

    return [page() for _ in range(n)]
