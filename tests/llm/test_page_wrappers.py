"""Articles inside wrappers with telling names, and the density of every node against its definition."""

from __future__ import annotations

import math
import random

import pytest

from rollbook.llm.html_density import BLOCK, main_text, measure, parse

ARTICLE = "".join(f"<p>Sentence {i} of an article that is long enough to be one, with a comma or two.</p>" for i in range(8))
TEXT = "\n\n".join(f"Sentence {i} of an article that is long enough to be one, with a comma or two." for i in range(8))
AROUND = "<nav><a href=a>Home</a> <a href=b>News</a></nav>{}<div class='footer'>Imprint and small print</div>"


@pytest.mark.parametrize("name", ["layout-with-sidebar", "post-share-wrapper", "search-results", "entry related-work", "content-no-header", "ad-free", "page hasSidebar", "main-nav-layout"])
def test_wrappers_keep_their_article(name):
    assert main_text(f"<html><body>{AROUND.format(f'<div class={name!r}><div>{ARTICLE}</div></div>')}</body></html>") == TEXT
    assert main_text(f"<html><body><div id={name!r}>{AROUND.format(f'<section>{ARTICLE}</section>')}</div></body></html>") == TEXT


def test_a_form_around_the_page():
    page = f"<body><form action=x>{AROUND.format(f'<div>{ARTICLE}</div>')}<div class=sidebar><p>More of this and that</p></div></form></body>"
    assert main_text(page) == TEXT


@pytest.mark.parametrize("name", ["comments", "ad", "sidebar", "share", "search", "related", "cookie-consent", "footer"])
def test_parts_of_a_page_go(name):
    part = f"<div class='{name}'><p>Some words that are not the article, and more of them here.</p></div>"
    assert main_text(f"<body><div>{ARTICLE}</div>{part}</body>") == TEXT
    assert main_text(f"<body><div>{ARTICLE}{part}</div></body>") == TEXT
    assert main_text(f"<body><div>{ARTICLE}</div><form><p>Your name and your address please.</p></form></body>") == TEXT


def test_long_comments_and_lone_adverts_go():
    comments = "".join(f"<p>Reader {i} says something at length that nobody asked for, again and again.</p>" for i in range(60))
    assert main_text(f"<body><article>{ARTICLE}</article><div id=comments>{comments}</div></body>") == TEXT
    assert main_text("<body><div class='ad'>Buy now and save a lot of money today</div></body>") == ""


def random_page(rng, depth=0):
    out = []
    for _ in range(rng.randint(1, 4)):
        kind = rng.random()
        if kind < 0.4 or depth > 4:
            out.append(" ".join("word" * rng.randint(1, 3) for _ in range(rng.randint(1, 12))))
        else:
            tag = rng.choice(["div", "p", "section", "a", "b", "ul", "li", "span", "h2"])
            out.append(f"<{tag}>{random_page(rng, depth + 1)}</{tag}>")
    return " ".join(out)


@pytest.mark.parametrize("seed", range(12))
def test_density_of_every_node(seed):
    _, nodes = parse(f"<html><body>{random_page(random.Random(seed))}</body></html>")
    body = measure(nodes)

    def below(n):
        return [x for x in nodes if x is not n and any(p is n for p in ancestors(x))]

    def ancestors(n):
        while n.parent is not None:
            n = n.parent
            yield n

    def chars(n):
        return sum(len(x.replace(" ", "").replace("\n", "")) for m in [n, *below(n)] for x in m.inside if isinstance(x, str))

    def links(n):
        inside = [m for m in [n, *below(n)] if m.tag == "a"]
        return sum(chars(m) for m in inside if not any(p in inside for p in ancestors(m))), len(inside)

    ratio = links(body)[0] / max(chars(body), 1)
    density = {}
    for n in nodes:
        c, t, (lc, lt) = chars(n), max(len(below(n)), 1), links(n)
        assert n.chars == c and (n.tag == "a" or n.link_chars == lc)
        if c:
            base = math.log(c / max(c - lc, 1) * lc + ratio * c + math.e)
            density[id(n)] = c / t * math.log(max(c / max(lc, 1) * t / max(lt, 1), 1.0)) / base
            assert math.isclose(n.density, density[id(n)], abs_tol=1e-9)
    for n in nodes:
        want = sum(density.get(id(x), 0.0) for x in n.inside if not isinstance(x, str) and x.tag in BLOCK)
        assert math.isclose(n.score, want, abs_tol=1e-9)
