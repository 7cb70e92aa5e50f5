"""The page reader on pages that a naive one needs the square of their length for."""

import time

import pytest

from entitylake.llm.html_blocks import read

PAGES = {
    "open double quotes": lambda n: '<a "' * (n // 4),
    "open single quotes": lambda n: "<a x='" * (n // 6),
    "quotes open across tags": lambda n: "<a x='>" * (n // 7 | 1),
    "quoted ends and one open quote": lambda n: '<a ">" ' * (n // 7) + "<a '",
    "open comments": lambda n: "<!--" * (n // 4),
    "open signs": lambda n: "<" * n,
    "open declarations": lambda n: "<!" * (n // 2),
    "end tags that close nothing": lambda n: "<div>" * (n // 10) + "</p>" * (n // 8),
    "end tags of an element far above": lambda n: "<b>" + "<div>" * (n // 10) + "</b>" * (n // 8),
    "texts in deep inline elements": lambda n: "<b>" * (n // 8) + "x<br>" * (n // 8),
    "items in deep blocks": lambda n: "<div>" * (n // 10) + "<li></li>" * (n // 18),
    "blocks in deep inline elements": lambda n: "<b>" * (n // 8) + "<div></div>" * (n // 22),
    "open values": lambda n: "<a " + 'x="' * (n // 3),
}


@pytest.mark.parametrize("name", list(PAGES))
def test_time_in_proportion_to_the_page(name):
    def seconds(n):
        page = PAGES[name](n)
        started = time.process_time()
        read(page)
        return time.process_time() - started

    seconds(20_000)
    assert seconds(800_000) < 16 * seconds(100_000) + 0.5


def test_quotes_that_stay_open():
    texts = lambda page: [block.text for block in read(page)[0]]
    assert texts('<p title="a>b">one</p><p title="two>three</p>') == ["one", "three"]
    assert texts("<p>a < b and c > d</p>") == ["a < b and c > d"]
    assert texts("<p>x</p><a 'y") == ["x", "<a 'y"]
    assert texts("<p>x<!-- open > <p>y") == ["x"]
