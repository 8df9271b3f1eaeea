"""Blocks that thresholds, names or omitted end tags must not take away."""

import pytest

from vigil.llm.html_text import main_text

NAV = "<ul><li><a href=1>Uno</a></li><li><a href=2>Due</a></li></ul>"
FOOT = "<div><a href=3>Privacy</a> <a href=4>Contatti</a></div>"
ITALIAN = ["Il governo italiano ha approvato ieri sera una nuova legge sulla scuola pubblica, che prevede fondi maggiori.",
           "Secondo il ministro, ogni regione riceverà risorse proporzionate alla popolazione studentesca residente."]
CHINESE = ["中国科学院的研究人员昨天宣布，他们在青藏高原发现了一种新的植物，这种植物能够在极端寒冷的环境中生长。", "研究人员表示，这一发现有助于理解植物如何适应气候变化，并且可能为农业提供新的基因资源和育种方法。"]
NUMBERS = ["Tensile 450 MPa, yield 310 MPa, elongation 22 %, hardness 140 HB, density 7.85 g/cm3, modulus 210 GPa, Poisson 0.29, melting 1425 C, " * 2]


@pytest.mark.parametrize("blocks", [ITALIAN, CHINESE, NUMBERS, ITALIAN[:1]])
def test_unmarked_pages_beyond_the_stop_words(blocks):
    want = "\n\n".join(b.strip() for b in blocks)
    assert main_text(NAV + "".join(f"<p>{b}</p>" for b in blocks) + FOOT) == want


def test_copyright_sign_within_prose():
    text = "The sign © was made law in the United States in 1909, and it is the one that most of the world has known since then. " * 3
    assert main_text(f"<p>{text}</p><p>© 2020 Example, all rights reserved</p>") == text.strip()


def test_linked_blocks_of_a_marked_article():
    page = "<nav><a href=n>menu</a></nav><article><h1><a href=x>Headline</a></h1><p>Text.</p><ol><li><a href=a>First reference</a></li></ol></article>"
    assert main_text(page) == "Headline\n\nText.\n\nFirst reference"


@pytest.mark.parametrize("page, want", [
    ("<article><p class=ad>Buy<p>Article text<p>More</article>", "Article text\n\nMore"),
    ("<article><ul><li class=social>Share<li>First<li>Second</ul><p>End</article>", "First\n\nSecond\n\nEnd"),
    ("<article><div><p class=ad>Buy<b>now</div><p>Text</article><p>out", "Text"),
    ("<article><table><tr><td class=ad>Buy<td>Cell<tr><td>Next</table>After</article>", "Cell\n\nNext\n\nAfter"),
    ("<article><dl><dt class=ad>Buy<dd>Meaning</dl></article>", "Meaning"),
    ("<article><div class=ad><ul><li>One<li>Two</ul><p>Buy</div>Text</article>", "Text"),
    ("<article><div class=ad>Buy</article><article>Second</article>", "Second"),
    ("<div><article><p>In</div><p>still in</article>", "In\n\nstill in"),
    ("<article><nav><ul><li>x</nav><p>Text", "Text"),
    ("<form><article><p>in</form>more</article><p>out", "in\n\nmore"),
])
def test_dropped_elements_end_where_browsers_end_them(page, want):
    assert main_text(page) == want


PROSE = "The results of the second study were the same as those of the first one, and they hold for all of the groups."


@pytest.mark.parametrize("inner, want", [
    (f"<section id='related-work'><p>{PROSE}</section>", PROSE),
    (f"<section id=search-algorithms><h2 id=share-prices>Share prices</h2><p>{PROSE}</section>", f"Share prices\n\n{PROSE}"),
    ("<p class=notice>Short but of the article", "Short but of the article"),
    ("<div class='article-header'><h1>Title</h1></div>", "Title"),
    ("<div class='tags-and-text'>Text</div>", "Text"),
    (f"<div class=related><p>{PROSE}</div>", PROSE),
    ("<div class='related-posts'><a href=x>Another one</a></div><div class='share-buttons'>Share</div><p>End", "End"),
    (f"<section id=comments><p>{PROSE}</section><div class='ad-slot'>{PROSE}</div><p>End", "End"),
    (f"<div class=notice>Short<p>{PROSE}</div><div class=social>Follow</div>End", f"Short\n\n{PROSE}\n\nEnd"),
])
def test_names_with_a_marking_word_keep_article_text(inner, want):
    assert main_text(f"<article>{inner}</article>") == want
