"""Labelled pages to learn from: written by hand as layouts and parts, put together by a seeded generator.

``#`` before a block's text marks main text; ``{s}`` is a sentence, ``{p}`` a few of them, ``{w}`` a word and
``{t}`` a title, of made-up words.  Everything else is menu, header, footer, sidebar, notice, advert, form or reader comment.
"""

from __future__ import annotations

import random
import re

MARK = "\ue000"  # begins a block of main text once a page is put together

HEADS = """<html><head><title>{t}</title><script>var a = "<p>{w}</p>";</script><style>p { margin: 0 }</style></head><body>
<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>{t}</title></head><body class="{w}">
<body>""".split("\n")

MENUS = """<nav><ul><li><a href="/{w}">{w}</a></li><li><a href="/{w}">{w}</a></li><li><a href="/{w}">{w}</a></li></ul></nav>
<div class="menu"><a href="/">{w}</a> | <a href="/{w}">{w}</a> | <a href="/{w}">{w} {w}</a></div>
<ul id="main-menu" class="nav"><li class="item"><a href="#">{w}</a><li class="item"><a href="#">{w}</a><li><a href="#">{w} {w}</a></ul>
<div role="navigation"><ul><li><a href="/{w}">{w}</a></li><li><a href="/{w}">{w}</a></li></ul></div>
<table class="navbar"><tr><td><a href="a">{w}</a></td><td><a href="b">{w}</a></td><td><a href="c">{w}</a></td></tr></table>
<div><a href="/a">{w}</a> <a href="/b">{w}</a> <a href="/c">{w}</a></div>
<ol class="breadcrumb"><li><a href="/">{w}</a></li><li><a href="/{w}">{w}</a></li><li>{t}</li></ol>
<p class="breadcrumbs"><a href="/">{w}</a> &raquo; <a href="/{w}">{w}</a> &raquo; {w}</p>""".split("\n")

HEADERS = """<header><a href="/">{w} {w}</a><p>{w} {w} {w}</p></header>
<header class="site-header"><div class="logo">{w}</div><h2>{w} {w}</h2><p class="tagline">{s}</p>MENU</header>
<header><h1>{w} {w}</h1>MENU</header>
<header><h1><a href="/">{w} {w}</a></h1><p>{s}</p>MENU</header>
<div id="header"><h1><a href="/">{w}</a></h1><p>{s}</p></div>
<div class="top-bar"><span>{w} {w}</span><a href="/login">{w}</a></div>
<div role="banner"><div class="masthead">{w} {w}</div></div>""".split("\n")

FOOTERS = """<footer>&copy; {w}.example.org &middot; {s}</footer>
<footer><p>&copy; 2024 {w}. {s}</p><ul><li><a href="/x">{w}</a></li><li><a href="/y">{w} {w}</a></li></ul></footer>
<div id="footer"><p>Copyright {w} {w}. All rights reserved.</p></div>
<div class="site-footer"><div class="links"><a href="a">{w}</a><a href="b">{w}</a></div><p>{s}</p></div>
<div role="contentinfo"><p>{s}</p><p><a href="/p">{w} {w}</a></p></div>
<div class="footer-widgets"><h4>{w} {w}</h4><p>{p}</p></div><footer><small>{s}</small></footer>
<p><small>&copy; {w} {w}</small></p>""".split("\n")

SIDES = """<aside><h3>{w} {w}</h3><ul><li><a href="a">{t}</a></li><li><a href="b">{t}</a></li><li><a href="c">{t}</a></li></ul></aside>
<div class="sidebar"><h3>{w}</h3><p>{p}</p><ul><li><a href="a">{t}</a><li><a href="b">{t}</a></ul></div>
<div id="secondary" class="widget-area"><div class="widget"><h4>{w}</h4><p>{s}</p></div><div class="widget"><h4>{w}</h4><p>{s}</p></div></div>
<div class="related-posts"><h4>{w} {w}</h4><ul><li><a href="a">{t}</a></li><li><a href="b">{t}</a></li></ul></div>
<section class="recommended"><h3>{w}</h3><div><a href="a">{t}</a><p>{s}</p></div><div><a href="b">{t}</a><p>{s}</p></div></section>
<aside class="sidebar"><p>{s}</p><p>{s}</p></aside>
<div role="complementary"><h3>{w}</h3><p>{p}</p></div>
<aside><p>{p}</p></aside>
<div class="teaser"><h4><a href="/t">{t}</a></h4><p>{s} <a href="/t">{w}</a></p></div>""".split("\n")

ADVERTS = """<div class="ad">{s}</div>
<div class="ad">{p}</div>
<div class="advertisement"><p>{s}</p><a href="http://{w}">{w} {w}</a></div>
<div id="ad-slot-3"><a href="x">{s}</a></div>
<aside class="promo"><h4>{t}</h4><p>{s}</p></aside>
<div class="sponsored-content"><h3>{t}</h3><p>{p}</p></div>
<div class="banner-ad"><p>{s}</p></div>
<section class="partner-offer promo"><p>{p}</p></section>""".split("\n")

NOTICES = """<div class="cookie-banner"><p>{s} cookies {s}</p><a href="/privacy">{w} {w}</a></div>
<div id="cookie-consent" role="dialog"><p>{p}</p><button>{w}</button></div>
<div class="notice"><p>{s}</p></div>
<div role="alert">{s}</div>
<div class="alert alert-info"><strong>{w}</strong> {s}</div>
<div class="modal" style="display:none"><h4>{t}</h4><p>{p}</p></div>
<div hidden><p>{p}</p></div>
<dialog><p>{s}</p></dialog>
<noscript><p>{s}</p></noscript>
<div class="paywall-message"><p>{p}</p></div>""".split("\n")

FORMS = """<form action="/s"><label>{w} {w}</label><input name="q"><button>{w}</button></form>
<form class="newsletter"><h4>{w} {w}</h4><p>{s}</p><input type="email"><button>{w}</button></form>
<div class="subscribe-box"><p>{s}</p><form><input><input type="submit"></form></div>
<form id="login"><p>{s}</p><label>{w}</label><input><select><option>{w}<option>{w}</select></form>
<div class="search-form"><form><fieldset><legend>{w}</legend><label>{w} {w}</label></fieldset></form></div>""".split("\n")

COMMENTS = """<section id="comments"><h3>3 {w}</h3><div class="comment"><p>{p}</p></div><div class="comment"><p>{s}</p></div></section>
<div class="comments"><h2>{w}</h2><ol class="commentlist"><li class="comment"><cite>{w}</cite><p>{p}</p></li><li class="comment"><cite>{w}</cite><p>{s}</p></li></ol>FORM</div>
<div id="disqus_thread"><p>{s}</p></div>
<section class="discussion"><article class="comment"><header>{w}</header><p>{p}</p></article><article class="comment"><header>{w}</header><p>{p}</p></article></section>
<ul class="replies"><li><b>{w}</b><p>{p}</p><li><b>{w}</b><p>{s}</p></ul>
<div class="reader-comments"><p><b>{w}</b>: {p}</p><p><b>{w}</b>: {s}</p><p><b>{w}</b>: {s}</p></div>""".split("\n")

SHARES = """<div class="share"><a href="f">{w}</a> <a href="t">{w}</a></div>
<ul class="social"><li><a href="f">{w}</a><li><a href="t">{w}</a></ul>""".split("\n")

PARTS = """<p>#{p}</p>
<p>#{p}</p>
<p>#{p}</p>
<p>#{p}</p>
<p>#{s}</p>
<p>#{s}</p>
<p>#{w}.</p>
<p><b>#{s}<br>
<p>#{s} <a href="/{w}">{w} {w}</a> {s}
<p>#<em>{w}</em> {p}</p>
<h2>#{t}</h2><p>#{p}</p>
<h3>#{t}</h3><p>#{s}</p>
<ul><li>#{s}</li><li>#{s}</li><li>#{w} {w}</li></ul>
<ol><li>#{s}<li>#{s}</ol>
<blockquote><p>#{p}</p></blockquote>
<blockquote>#{s}</blockquote>
<pre>#{w} = {w}</pre>
<table><tr><th>#{w}</th><th>#{w}</th></tr><tr><td>#{w}</td><td>#{s}</td></tr></table>
<figure><img src="x"><figcaption>#{s}</figcaption></figure>
<dl><dt>#{w}</dt><dd>#{s}</dd></dl>
<div>#{p}</div>
<section><h2>#{t}</h2><p>#{p}</p><p>#{p}</p></section>""".split("\n")

LAYOUTS = """HEAD HEADER? MENU NOTICE? ADVERT? <article><h1>#{t}</h1> PARTS </article> COMMENTS? SIDE? FOOTER
HEAD MENU ADVERT <article><h1>#{t}</h1> PARTS </article> FOOTER
HEAD HEADER <main><article><header><h1>#{t}</h1></header> PARTS INSIDE? PARTS </article> SIDE? COMMENTS? </main> FOOTER
HEAD NOTICE? HEADER MENU <div id="content"><h2>#{t}</h2> PARTS INSIDE? PARTS </div><div id="sidebar"> SIDE? FORM? ADVERT? </div> FOOTER
HEAD <div class="wrapper"> HEADER MENU <div class="post"><h1 class="title">#{t}</h1><div class="entry-content"> PARTS INSIDE? </div></div> COMMENTS? SIDE? </div> FOOTER
HEAD <table><tr><td> MENU </td><td> <h1>#{t}</h1> PARTS </td><td> SIDE? ADVERT? </td></tr></table> FOOTER
HEAD MENU <h1>#{t}</h1> PARTS PARTS FOOTER
HEAD <h1>#{t}</h1> PARTS
HEAD PARTS
HEAD HEADER <main id="main"><div class="article-body"> PARTS INSIDE? PARTS </div></main> COMMENTS? FOOTER NOTICE?
HEAD HEADER? <div><div><div><h1>#{t}</h1> PARTS </div></div></div><div> SIDE? ADVERT? </div> FOOTER
HEAD <section> MENU </section><section><h1>#{t}</h1> PARTS ADVERT? PARTS </section><section> COMMENTS? FORM? </section> FOOTER
HEAD HEADER <div class="story"> INSIDE? <div> PARTS </div> INSIDE? <div> PARTS </div></div> SIDE FOOTER
HEAD NOTICE HEADER MENU <main role="main"> FORM? <article class="post"><h1>#{t}</h1> PARTS INSIDE PARTS </article> INSIDE? COMMENTS </main> SIDE FOOTER
HEAD HEADER MENU <div class="container"><div class="row"><div class="col"><h1>#{t}</h1> PARTS COMMENTS? </div><div class="col"> SIDE </div></div></div> FOOTER
HEAD MENU <div class="page"><p>#{p}<br><br>#{p}</p> PARTS </div> FOOTER
HEAD NOTICE? HEADER <main><article><header><h1>#{t}</h1><p class="byline">{w} <a href="/a">{w} {w}</a>, {w}</p></header> PARTS ADVERT? PARTS INSIDE? PARTS </article> COMMENTS </main> SIDE FOOTER
HEAD HEADER <article><h1>#{t}</h1><div class="meta">{w} {w}</div> PARTS INSIDE? </article> COMMENTS? SIDE? FOOTER
HEAD HEADER? <div id="main"><div class="inner"><h1>#{t}</h1> PARTS ADVERT? PARTS </div> SIDE </div> COMMENTS? FOOTER
<p>#{s}</p>
#{p}
HEAD <p>#{p}</p><p>#{s}</p>
<div>#{p}</div><div>#{p}</div>
HEAD HEADER MENU SIDE SIDE? FORM? NOTICE? FOOTER
HEAD MENU SIDE? ADVERT? FOOTER""".split("\n")

SECTIONS = {"HEAD": HEADS, "MENU": MENUS, "HEADER": HEADERS, "FOOTER": FOOTERS, "SIDE": SIDES, "ADVERT": ADVERTS, "NOTICE": NOTICES,
            "FORM": FORMS, "COMMENTS": COMMENTS}
INSIDE = ("ADVERT", "SIDE", "NOTICE", "FORM", "SHARE")


class Writer:
    def __init__(self, seed: int):
        self.random = random.Random(seed)
        syllables = ["".join(self.random.choices("bcdfghklmnprstvw", k=self.random.choice([1, 1, 2]))) + self.random.choice("aeiouäéó") for _ in range(60)]
        self.words = ["".join(self.random.choices(syllables, k=self.random.randint(1, 4))) for _ in range(400)]

    def word(self) -> str:
        return self.random.choice(self.words)

    def sentence(self) -> str:
        words = [self.word() for _ in range(self.random.choice([2, 4, 6, 9, 12, 16, 22]))]
        if len(words) > 8:
            words[len(words) // 2] += ","
        return " ".join(words).capitalize() + self.random.choice("...!?")

    def fill(self, text: str) -> str:
        by_kind = {"{w}": self.word, "{s}": self.sentence, "{t}": lambda: " ".join(self.word() for _ in range(self.random.randint(2, 8))).capitalize(),
                   "{p}": lambda: " ".join(self.sentence() for _ in range(self.random.choice([1, 1, 2, 2, 3, 4, 6])))}
        return re.sub(r"\{[wstp]\}", lambda m: by_kind[m[0]](), text)

    def section(self, name: str) -> str:
        if name == "PARTS":
            return "\n".join(self.random.choice(PARTS) for _ in range(self.random.choice([1, 1, 2, 3, 5, 9, 14])))
        if name == "INSIDE":
            name = self.random.choice(INSIDE)
        text = self.random.choice(SHARES if name == "SHARE" else SECTIONS[name])
        return re.sub("MENU|FORM", lambda m: self.random.choice(SECTIONS[m[0]]), text)

    def page(self) -> str:
        def part(m):
            if m[2] and self.random.random() < 0.5:
                return ""
            return self.section(m[1])

        layout = re.sub(r"\b([A-Z]{4,})\b(\??)", part, self.random.choice(LAYOUTS))
        # Marks are set before the blanks are filled, as words could hold the sign.
        return self.fill(re.sub(r"#(?=\{|<em>)", MARK, layout))


def labelled_pages(count: int, seed: int = 11) -> list[str]:
    """``count`` pages in which main text begins with ``MARK``."""
    writer = Writer(seed)
    return [writer.page() for _ in range(count)]
