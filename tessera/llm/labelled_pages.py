"""Labelled pages that the main-text model is trained from.

Layouts written by hand; `data-keep` says which elements are content.  Slots are
filled with invented words: {w} a few words, {s} a sentence, {p} a paragraph,
{j} a paragraph of broken pieces without sentences, {a} a link.
"""

from __future__ import annotations

import random
import re

SEEDS = 14  # pages of each layout
MENU = "<ul><li>{a}</li><li>{a}</li><li>{a}</li><li>{a}</li></ul>"
BODY = "<h1>{w}</h1><p>{p}</p><p>{p}</p><p>{s}</p><p>{p}</p>"

LAYOUTS = [
    f"<html><head><title>{{w}}</title><style>p{{}}</style></head><body><nav>{MENU}</nav><div class='ad'>{{s}}</div><article data-keep='1'>{BODY}</article><footer>&copy; {{w}} {{s}}</footer></body></html>",
    f"<body><nav>{MENU}</nav><!-- x --><div class='ad'>{{s}}</div><article data-keep='1'><h1>{{w}}</h1><p><b>{{w}}<br><p>{{j}}</p><p>{{j}}</p></article><footer>&copy; {{w}} &middot; {{s}}</footer>",
    "<body><nav>{a} {a} {a}</nav><div class='ad'>{p}</div><article data-keep='1'><h1>{w}</h1><p><b>{w}<br></article><footer>&copy; {w}</footer></body>",
    f"<body><header><div id='logo'>{{w}}</div><nav>{MENU}</nav></header><main data-keep='1'><h1>{{w}}</h1><p>{{p}}</p><h2>{{w}}</h2><p>{{p}}</p><ul><li>{{s}}</li><li>{{w}}</li></ul></main><aside data-keep='0'><h3>{{w}}</h3><p>{{s}}</p>{MENU}</aside><footer><p>&copy; {{w}}</p>{{a}} {{a}}</footer></body>",
    f"<body><div id='header'><h2>{{w}}</h2><div class='menu'>{MENU}</div></div><div id='content' data-keep='1'>{BODY}<blockquote>{{s}}</blockquote></div><div id='sidebar'><h3>{{w}}</h3>{MENU}<p>{{s}}</p></div><div id='footer'>{{w}} {{a}} | {{a}}</div></body>",
    f"<body><div class='cookie-notice'><p>{{s}} {{s}}</p><button>{{w}}</button></div><div class='nav'>{{a}} | {{a}} | {{a}}</div><div class='post'><div class='entry-content' data-keep='1'>{BODY}</div><div class='share'>{{a}} {{a}}</div><div class='comments'><h3>{{w}}</h3><div class='comment'><p>{{w}}</p><p>{{p}}</p></div><div class='comment'><p>{{s}}</p></div></div></div><div class='footer'>© {{w}}</div></body>",
    f"<body><table><tr><td colspan=2>{{a}} {{a}} {{a}}</td></tr><tr><td width=150>{MENU}</td><td data-keep='1'><h1>{{w}}</h1><p>{{p}}<p>{{p}}<p>{{p}}</td></tr><tr><td colspan=2>© {{w}}</td></tr></table></body>",
    f"<body><section class='hero banner'><h2>{{w}}</h2><p>{{s}}</p></section><article data-keep='1'><header><h1>{{w}}</h1></header><section><h2>{{w}}</h2><p>{{p}}</p><figure><figcaption>{{s}}</figcaption></figure></section><section><p>{{p}}</p><table><tr><th>{{w}}</th><td>{{w}}</td></tr></table></section><aside class='related' data-keep='0'><h4>{{w}}</h4>{MENU}</aside><form data-keep='0'><p>{{s}}</p><input><label>{{w}}</label></form><footer data-keep='0'>{{w}} {{a}}</footer></article><section id='comments'><h2>{{w}}</h2><article class='comment'><p>{{p}}</p></article><article class='comment'><p>{{s}}</p><p>{{s}}</p></article></section><footer><p>{{s}}</p></footer></body>",
    f"<body><form id='aspnet'><div class='top'>{MENU}</div><div class='article' data-keep='1'>{BODY}</div><div class='right'><div class='advert'>{{s}} {{p}}</div>{MENU}</div></form><div class='copyright'>© {{w}} {{s}}</div></body>",
    "<body data-keep='1'><h1>{w}</h1><p>{p}</p><p>{p}</p><p>{s}</p><p data-keep='0'>{a} | {a} | {a}</p></body>",
    "<body><nav>{a} {a}</nav><div class='alert notice'>{s}</div><article data-keep='1'><p>{w}</p></article><aside><p>{p}</p></aside><footer>{s}</footer></body>",
    f"<body><div role='navigation'>{MENU}</div><div role='main' data-keep='1'>{BODY}<pre>{{w}}</pre><ol><li>{{s}}</li><li>{{s}}</li></ol><div class='promo' data-keep='0'><p>{{s}}</p></div><p>{{p}}</p></div><div role='complementary'><p>{{s}}</p>{MENU}</div><div role='contentinfo'>{{s}}</div></body>",
    f"<body><div><div>{{a}} {{a}} {{a}} {{a}}</div><div><div data-keep='1'><h1>{{w}}</h1><p>{{p}}</p><p>{{p}}</p><p>{{p}}</p></div><div>{MENU}</div></div><div>© {{w}}</div></div></body>",
    f"<body><header><h2>{{w}}</h2><p>{{s}}</p><form class='search'><input><p>{{w}}</p></form></header><div class='newsletter'><h3>{{w}}</h3><p>{{s}} {{s}}</p><form><input></form></div><article data-keep='1'>{BODY}<p>{{a}} {{s}}</p><p>{{w}}</p></article><div class='sponsored'><p>{{p}}</p></div><footer>{MENU}<p>{{s}}</p></footer></body>",
    f"<body><nav>{MENU}</nav><article data-keep='1'><h1>{{w}}</h1><div><div><p>{{p}}</p></div><div>{{p}}</div></div><p>{{j}}</p><div class='ad' data-keep='0'>{{s}}</div><p>{{s}}</p><nav data-keep='0'>{MENU}</nav></article><section class='comments'><ol><li><p>{{p}}</p></li><li><p>{{s}}</p></li></ol><form><textarea></textarea><p>{{s}}</p></form></section><footer><div>{{s}}</div></footer></body>",
    f"<body><div class='modal popup'><h3>{{w}}</h3><p>{{s}}</p></div><div class='wrapper'><div class='story-body' data-keep='1'><h1>{{w}}</h1>{{p}}<br><br>{{p}}<ul><li>{{w}}</li><li>{{w}}</li></ul><dl><dt>{{w}}</dt><dd>{{s}}</dd></dl></div><div class='tags' >{{a}} {{a}}</div><div class='widget'><h4>{{w}}</h4><p>{{s}}</p></div></div><div class='legal'><p>{{s}} {{s}}</p></div></body>",
    "<body><article data-keep='1'><h1>{w}</h1><p>{j}</p><p>{w}</p><p>12 34 56</p><p>{a}</p></article><footer>{w}</footer></body>",
    f"<body><header><h1>{{w}}</h1><p>{{s}}</p><nav>{MENU}</nav></header><article data-keep='1'>{BODY}<div class='newsletter' data-keep='0'><p>{{s}}</p></div><p>{{p}}</p><section class='comments' data-keep='0'><h3>{{w}}</h3><p>{{s}}</p><p>{{p}}</p></section></article><footer>{{s}}</footer></body>",
    f"<body><div class='header'><h1>{{w}}</h1>{MENU}</div><div class='content' data-keep='1'><h2>{{w}}</h2><p>{{p}}</p><div class='subscribe' data-keep='0'><h4>{{w}}</h4><p>{{s}} {{s}}</p></div><p>{{s}}</p><p>{{p}}</p><div class='share' data-keep='0'><p>{{w}}</p></div><div class='comment-list' data-keep='0'><div><p>{{p}}</p></div><div><p>{{s}}</p></div></div></div><div class='bottom'><p>© {{w}}. {{s}}</p></div></body>",
    "<body data-keep='1'>{p}<br>{p}<div class='ad' data-keep='0'>{s}</div><br>{s}</body>",
    "<body data-keep='1'>{w}</body>",
    "<html data-keep='1'>{p}</html>",
    f"<html><body data-keep='1'><nav data-keep='0'>{MENU}</nav><h1>{{w}}</h1><p>{{p}}</p><p>{{s}}</p><p>{{p}}</p><aside data-keep='0'><p>{{p}}</p></aside><footer data-keep='0'>{{s}}</footer></body></html>",
    f"<body><div id='cookie-banner'>{{s}}</div><header><h1>{{w}}</h1></header><main><article data-keep='1'><h2>{{w}}</h2><p>{{s}}</p><div class='notice' data-keep='0'>{{s}}</div><p>{{p}}</p><div class='sponsor' data-keep='0'><p>{{p}}</p></div><p>{{s}}</p><form data-keep='0'><div><p>{{s}}</p></div></form><div class='replies' data-keep='0'><p>{{p}}</p></div></article></main><footer><p>{{s}}</p></footer></body>",
    f"<body><nav class='breadcrumbs'>{{a}} / {{a}} / {{w}}</nav><main><article data-keep='1'>{BODY}</article><div class='comments-area'><div><p>{{w}}</p><p>{{p}}</p></div></div><aside><section><h2>{{w}}</h2>{MENU}</section><section class='ads'><p>{{p}}</p></section></aside></main><footer><section><p>{{s}}</p></section></footer></body>",
]


def _words(r: random.Random, least: int, most: int) -> str:
    parts = ["".join(r.choice(["ba", "ke", "ri", "no", "stu", "ma", "le", "an", "tor", "é", "sch"]) for _ in range(r.randint(1, 4)))
             for _ in range(r.randint(least, most))]
    return " ".join(parts)


def _filled(r: random.Random, slot: str) -> str:
    if slot == "w":
        return _words(r, 1, 7)
    if slot == "a":
        return f"<a href='/{r.randint(1, 999)}'>{_words(r, 1, 4)}</a>"
    if slot == "j":
        return " ".join(_words(r, 1, 2) + r.choice([" |", " ;", " -", " #", "", "!!"]) for _ in range(r.randint(2, 30)))
    one = lambda: (_words(r, 4, 16) + r.choice([".", ".", ".", "?", "!"])).capitalize()
    if slot == "s":
        return one()
    return " ".join(one() if r.random() < 0.9 else f"{_words(r, 2, 4)} <a href='/x'>{_words(r, 1, 3)}</a> {_words(r, 2, 4)}."
                    for _ in range(r.choice([1, 2, 3, 5, 9, 20])))


def labelled_pages() -> list[str]:
    """SEEDS pages of every layout; the same on every call."""
    out = []
    for k, layout in enumerate(LAYOUTS):
        for seed in range(SEEDS):
            r = random.Random(1000 * k + seed)
            out.append(re.sub(r"\{([wspja])\}", lambda m: _filled(r, m[1]), layout))
    return out
