"""Encoding, planes, packing, fingerprints, templates, web pages and near duplicates against brute force."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from entitylake.llm import bin_slack, bitplanes, chat_template, chosen_path, html_blocks, html_template, shared, shingles, syncmers
from entitylake.llm.components import components, roots_of
from entitylake.llm.encoder import VOCABULARY, PieceEncoder, encoder
from entitylake.llm.template import Template, TemplateError


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def as_bytes(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


PARTS = [" ", "  ", "\n", "\t", " ", "　", "​", "\x85", "\x1c", "a", "Bc", "é", "1", "'s", "n't", "...", "<|endoftext|>", "日本", "́", "😀", "\x00", "\r\n", "Æther"]


def test_pieces_encode_like_whole_texts(plain):
    draw = random.Random(1)
    texts = ["".join(draw.choices(PARTS, k=draw.randint(0, 30))) for _ in range(4000)]
    assert encoder().encode([None, *texts]) == [as_bytes(plain(text)) for text in ["", *texts]]


def test_parts_of_pieces_encode_like_whole_texts(plain):
    """Line breaks, quotes, digits and signs at every edge of words."""
    draw = random.Random(2)
    words = ["it", "Ünder", "été", "a", "ǅx", "×", "µ", "ª", "12", "٣", "x1y2"]
    edges = [".", ",\n", "\n", "\n\n", "'s", "'", "\"", "'\n", "...", "—", "”", "(", "\r\n", "\n'", "_", "#1", "$", "\x7f", "\x85"]
    texts = [
        "".join(draw.choice([" ", "", "\n"]) + draw.choice(edges + [""] * 9) + draw.choice(words) + draw.choice(edges + [""] * 9) for _ in range(draw.randint(1, 9)))
        for _ in range(6000)
    ]
    texts += [word + edge + other for word in words for edge in edges for other in ["", *words]]
    assert encoder().encode(texts) == [as_bytes(plain(text)) for text in texts]


def test_added_tokens_are_the_library_s(plain):
    text = "a<|endoftext|>b it.\nc"
    assert plain(text)[1] == 50256
    assert encoder().encode([text, "a<|endoftext|", text]) == [as_bytes(plain(x)) for x in (text, "a<|endoftext|", text)]


def test_memo_is_bounded(plain, monkeypatch):
    monkeypatch.setattr("entitylake.llm.encoder.MEMO_PIECES", 3)
    small = PieceEncoder(public_tokenizers.path(VOCABULARY))
    text = " ".join(f"word{chr(97 + i)}" for i in range(20)) + " " + "x" * 100
    assert small.encode([text, text]) == [as_bytes(plain(text))] * 2 and len(small) <= 3


@pytest.mark.parametrize("mode", [bitplanes.BYTES, bitplanes.BITS])
def test_plane_files_round_trip(mode):
    draw = np.random.default_rng(4)
    documents = [(k or None, draw.integers(0, 2**32, int(n), dtype=np.uint32).tobytes()) for k, n in enumerate([0, 5, 1000, 0, 3, 77])]
    data = bitplanes.packed(documents, mode, block_ids=64)
    opened = bitplanes.PlaneFile(data)
    assert [(number, body) for number, _, body in opened.documents()] == documents
    everything = np.frombuffer(b"".join(body for _, body in documents), "<u4")
    for start, count in ((0, 1), (60, 10), (63, 130), (1000, 85), (5, 0)):
        assert (opened.read(start, count) == everything[start : start + count]).all()
    assert list(bitplanes.PlaneFile(bitplanes.packed([], mode)).documents()) == []
    with pytest.raises(ValueError):
        bitplanes.PlaneFile(b"x" * 40)


ROWS = [(5, "some text here"), (2, None), (9, ""), (None, "no id"), (2, "again"), (2, "again"), (7, "long " * 30_000)]


def test_ids_are_written_in_order_and_read_back(documents, spark, plain, monkeypatch):
    path = shared.shared_folder(spark)
    bitplanes.write_ids(documents(*ROWS, extra=("part", "data")), path)
    found = bitplanes.digests(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in found] == [None, 2, 2, 2, 5, 7, 9]
    texts, at = Counter((k, text) for k, text in ROWS), 0
    sums = {(k, zlib.crc32(as_bytes([*plain(text), 2]))): n for (k, text), n in texts.items()}
    for row in found:
        assert row["start"] == at and (row["doc_id"], row["ids_crc32"]) in sums
        at += row["n_tokens"]
    assert {r["doc_id"]: r["ids"] for r in bitplanes.read_ids(spark, path).collect()}[5] == [*plain("some text here"), 2]
    empty = shared.shared_folder(spark)
    bitplanes.write_ids(documents(), empty)
    assert bitplanes.digests(spark, empty).count() == 0


def brute_fill(lengths, capacity):
    reachable = {0}
    for length, count in lengths.items():
        for _ in range(count):
            reachable |= {s + length for s in reachable if s + length <= capacity}
    return max(reachable)


def test_fill_is_the_closest_sum():
    draw = random.Random(2)
    for _ in range(300):
        lengths = {draw.randint(1, 40): draw.randint(0, 4) for _ in range(draw.randint(0, 6))}
        capacity = draw.randint(0, 60)
        used = bin_slack.fill(lengths, capacity)
        assert all(0 < count <= lengths[length] for length, count in used.items())
        assert sum(k * v for k, v in used.items()) == brute_fill(lengths, capacity)


def test_plan_uses_the_histogram_up():
    draw = random.Random(3)
    histogram = {length: draw.randint(1, 10**6) for length in range(1, 1025)}
    patterns = bin_slack.plan(dict(histogram))
    used = Counter()
    for pattern in patterns:
        assert sum(length * count for length, count in pattern.counts) <= 1024
        for length, count in pattern.counts:
            used[length] += count * pattern.times
    assert used == histogram
    windows = sum(pattern.times for pattern in patterns)
    assert windows * 1024 < 1.02 * sum(length * count for length, count in histogram.items())
    assert bin_slack.plan({}) == []


def test_packing_covers_every_id_once(documents, plain):
    rows = [*ROWS, *[(100 + i, "many short ones " * (i % 50)) for i in range(300)]]
    table = documents(*rows, extra=("task", "serial", "length"))
    found = bin_slack.packing(table).collect()
    expected = Counter((k, len(plain(text)) + 1) for k, text in rows)
    assert Counter((r["doc_id"], r["doc_tokens"]) for r in found if r["start"] == 0) == expected
    windows = {}
    for row in found:
        windows.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    assert sorted(windows) == list(range(len(windows)))
    total = sum(row["length"] for row in found)
    assert total == sum(size * n for (_, size), n in expected.items()) and len(windows) <= total // 1024 + 2
    one = [r for r in found if r["doc_id"] == 7]
    ids = [*plain("long " * 30_000), 0]
    assert all(zlib.crc32(as_bytes(ids[r["start"] : r["start"] + r["length"]])) == r["ids_crc32"] for r in one)
    assert bin_slack.packing(documents()).count() == 0


def test_sequences_hold_their_pieces(documents, plain):
    cut = bin_slack.pieces(documents((1, "one two three"), (2, "four"), (3, None)))
    found = bin_slack.sequences(cut).collect()
    assert len(found) == 1 and sorted(found[0]["doc_ids"]) == [1, 2, 3]
    bodies = {1: [*plain("one two three"), 0], 2: [*plain("four"), 0], 3: [0]}
    assert bytes(found[0]["ids"]) == as_bytes([i for k in found[0]["doc_ids"] for i in bodies[k]])


def brute_anchors(text):
    n = len(text)
    _, k, s = next(size for size in syncmers.SIZES if n >= size[0])

    def code(part):
        value = sum((ord(c) + 1) * pow(syncmers._BASE, i, 1 << 64) for i, c in enumerate(part)) % (1 << 64)
        value = ((value ^ (value >> 32)) * 0x9E3779B97F4A7C15) % (1 << 64)
        return value ^ (value >> 29)

    inner = [code(text[i : i + s]) for i in range(n - s + 1)]
    width = k - s + 1
    places = [i for i in range(n - k + 1) if min(inner[i], inner[i + width - 1]) == min(inner[i : i + width])]
    return [code(text[i : i + k]) >> 40 for i in places], places


@pytest.mark.parametrize("text", ["x", "ab", "eleven char", "twelve chars", "words and words " * 4, "Ä" * 200, "The text of a page, 日本 and 😀 more. " * 6])
def test_anchors_match_brute_force(text):
    hashes, places = syncmers.anchors(text)
    assert (hashes.tolist(), places.tolist()) == brute_anchors(text) and len(places)
    mark = syncmers.Fingerprint.of(text)
    read = syncmers.Fingerprint.parsed(mark.shown)
    assert (read.hashes == mark.hashes).all() and (read.places == mark.places).all()
    assert mark.likeness(mark) == 1 and mark.likeness(syncmers.Fingerprint.of("")) == 0


def test_neighbours_and_edits(documents):
    draw = random.Random(5)
    rows = [(3 * i, " ".join(draw.choices("alpha beta gamma delta epsilon".split(), k=draw.randint(1, 200)))) for i in range(1500)]
    rows += [(7000, None), (7001, ""), (7002, "long text " * 20_000)]
    found = {r["doc_id"]: r for r in syncmers.compared(documents(*rows, extra=("bucket", "guest"))).collect()}
    ordered = sorted(rows, reverse=True)
    assert len(found) == len(rows)
    for k, (number, text) in enumerate(ordered):
        text, after = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = found[number]
        assert row["n_chars"] == len(text) and row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        mark = syncmers.Fingerprint.of(text)
        assert row["fingerprint"] == mark.shown
        assert row["near_edited"] == mark.likeness(syncmers.Fingerprint.of(edited))
        assert row["near_next"] == mark.likeness(syncmers.Fingerprint.of(after))


@pytest.mark.parametrize("rows", [[], [(5, "one")], [(None, "a b"), (None, None)], [(1, "x"), (1, "x"), (2, None), (None, "q")], [(3, "aaa")] * 5])
def test_neighbours_of_odd_tables(documents, rows):
    found = syncmers.compared(documents(*rows)).collect()
    assert sorted((str(r["doc_id"]), r["n_chars"]) for r in found) == sorted((str(k), len(t or "")) for k, t in rows)
    assert {r["fingerprint"] for r in syncmers.fingerprints(documents(*rows)).collect()} == {r["fingerprint"] for r in found}


TRICKS = ["<", "|", "\\", "[INST]", "</s>", "[/INST]", "<|end|>\n", "<|text|>", "<|turn|>", "a", "\n", "[", "]"]


def test_formatting_is_reversible():
    draw, shape = random.Random(6), chat_template.template()
    for _ in range(3000):
        role = lambda: draw.choice(["user", "assistant", "".join(draw.choices(TRICKS, k=3))])
        turns = [{"role": role(), "text": "".join(draw.choices(TRICKS, k=draw.randint(0, 9)))} for _ in range(draw.randint(0, 4))]
        text, spans = shape.render(messages=turns)
        read = list(chat_template.read_back(shape.pieces(messages=iter(turns))))
        assert [{"role": r, "text": t} for r, t, _, _ in read] == turns
        assert sum(n for *_, n in read) == len(text)
        spoken = [t["text"] for t in turns if t["role"] == "assistant"]
        assert [g for _, _, g, _ in read if g] == [t for t in spoken if t]
        assert [chat_template.unescape(text[a:b]) for a, b in spans] == [t for t in spoken if t]


def test_template_language():
    shape = Template("{# note #}a{%- if x == 'é' and not y -%} yes {%- elif z -%} z {%- else -%} no {%- endif %}{{ 'q' ~ 1 | upper }}{{ m.k['v'] }}")
    assert shape.render(x="é", m={"k": {"v": 3}})[0] == "ayesq13" and shape.render(z=1)[0] == "azq1" and shape.render()[0] == "anoq1"
    folded = Template("{% if 1 == 1 %}{{ 'a' ~ 'b' }}{% else %}{{ x }}{% endif %}c")
    assert len(folded.tree.parts) == 1 and folded.tree.parts[0].value.value == "abc"
    loop = Template("{% for m in ms %}{{ loop.index }}{% if not loop.last %},{% endif %}{% endfor %}")
    assert loop.render(ms=iter("abc"))[0] == "1,2,3" and loop.render(ms=[])[0] == ""
    assert Template("{{ x.__class__ }}{{ x['__init__'] }}").render(x="text")[0] == ""
    for broken in ("{% for x in y %}", "{% while x %}", "{{ x | nothing }}", "{{ 'a' 'b' }}", "{{ x( }}", "{{ }}", "{% if x %}"):
        with pytest.raises(TemplateError):
            Template(broken)


def test_conversations(spark):
    schema = "conv_id long, turn long, role string, text string, n_turns string"
    rows = [(1, 1, "assistant", "b", ""), (1, 0, "user", "a", ""), (2, 0, None, None, ""), (None, 0, "user", "x", ""), (1, 1, "assistant", "b", "")]
    rows += [(9, i, "assistant", "long " * 50, "") for i in range(3000)]
    table = spark.createDataFrame(rows, schema)
    found = {r["conv_id"]: r for r in chat_template.digests(table).collect()}
    assert {k: r["n_turns"] for k, r in found.items()} == {1: 3, 2: 1, None: 1, 9: 3000}
    assert found[1]["turns_sha256"] == hashlib.sha256(b"user\na\nassistant\nb\nassistant\nb\n").hexdigest()
    assert found[1]["loss_sha256"] == hashlib.sha256(b"bb").hexdigest() and found[9]["loss_chars"] == 750_000
    whole = {r["conv_id"]: r for r in chat_template.formatted(table).collect()}
    assert all(len(whole[k]["text"]) == r["formatted_chars"] for k, r in found.items())
    assert chat_template.digests(table.limit(0)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p><p>no";</script></head>
<body class="home"><header>Site</header><nav><ul><li><a href="/">Home</a><li>About</ul></nav><div class="cookie-notice">We use cookies</div>
{main}<aside>Side</aside><div id="comments"><p>Nice post</div><form><p>Name</form><div class="ad">Buy</div><footer>&copy; 2020</footer></body></html>"""


def text_of(page):
    return html_blocks.main_text(html_blocks.read(page)[0])


def test_main_text_of_pages():
    article = "<article class='post'><h1>Head &amp;\n line</h1><p>One <b>bo</b>ld&nbsp;text<br>next<p>Two<ul><li>a<li>b</ul><div class=share>Tweet</div></article>"
    assert text_of(PAGE.format(main=article)) == "Head & line One bold text next Two a b"
    assert text_of(PAGE.format(main="<div id=main><p>Only 1 < 2 this</p></div>")) == "Only 1 < 2 this"
    assert text_of(PAGE.format(main="<p>Bare &lt;b&gt; text")) == "Bare <b> text"
    assert text_of("<article><p>open <!-- never closed") == "open" and text_of("") == "" and text_of("just text") == "just text"
    assert text_of("<p>a</b></div></p>b<table><tr><td>c<td>d<tr><td>e</table>") == "a b c d e"
    assert text_of("<div hidden>x</div><div style='display: none'>y</div><p>z") == "z"


def test_constant_texts_of_a_host_are_its_template(spark):
    def page(k):
        return f"<html><body><div class=top>Welcome to us</div><div class=text><p>Story {k} of many</p><p>It ends {k}.</p></div><div class=low>All rights</div></body></html>"

    rows = [(k, f"http://Host.example.org:80/{k}", page(k)) for k in range(8)]
    rows += [(100, "http://other.example.org/", page(1)), (101, None, page(2)), (102, "http://host.example.org/", None), (0, "http://host.example.org/0", page(0))]
    table = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    found = html_template.extracted(table)
    assert found.columns == ["page_id", "url", "html", "text", "n_chars"]
    texts = {r["page_id"]: r["text"] for r in found.collect()}
    assert all(texts[k] == f"Story {k} of many It ends {k}." for k in range(8)) and texts[102] == ""
    assert texts[100] == "Welcome to us Story 1 of many It ends 1. All rights"
    assert found.count() == len(rows) and html_template.extracted(table.limit(0)).count() == 0


def brute_sets(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def brute_components(rows, size):
    sets = [brute_sets(text, size) for _, text in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    return sets, [find(k) for k in range(len(rows))]


def near_copies(seed=7):
    """Unrelated texts, groups of exact copies, chains of small edits, a shared passage, pairs at the very threshold."""
    draw, rows = random.Random(seed), []
    word = lambda: f"w{draw.randint(0, 5000)}"
    passage = [word() for _ in range(30)]
    for _ in range(60):
        rows.append([word() for _ in range(draw.randint(1, 90))] + (passage if draw.random() < 0.4 else []))
    for size in (3, 60):
        base = [word() for _ in range(120)]
        for _ in range(size):
            copy = list(base)
            copy[draw.randrange(len(copy))] = word()
            rows.append(copy)
    chain = [word() for _ in range(100)]
    for _ in range(12):
        chain = list(chain)
        chain[draw.randrange(len(chain))] = word()
        rows.append(chain)
    first = [f"u{i}" for i in range(44)]
    rows += [first, [*first[:40], "other"], [*first[:39], "other"]]
    texts = [" ".join(row) for row in rows] + [rows[0][0].upper()] * 3 + [None, "", " \n", "One two", "one TWO", " ".join(rows[70])]
    return [(7 * k % 1009, text) for k, text in enumerate(texts)]


def check_components(found, rows, size):
    sets, roots = brute_components(rows, size)
    least = {}
    for (number, _), root in zip(rows, roots, strict=True):
        least[root] = min(number, least.get(root, number))
    expected = {number: (len(s), least[root]) for (number, _), s, root in zip(rows, sets, roots, strict=True)}
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


@pytest.mark.parametrize("size", [4, 5])
def test_components_match_brute_force(documents, size):
    rows = near_copies()
    check_components(chosen_path.similar(documents(*rows, extra=("class", "node")), words=size).collect(), rows, size)


@pytest.mark.parametrize("depth", [3, 9])
def test_large_nodes_lose_no_link(documents, monkeypatch, depth):
    """With tiny nodes nearly every pair goes through the way for large ones."""
    monkeypatch.setattr(chosen_path, "SMALL", 2)
    monkeypatch.setattr(chosen_path, "BLOCK", 7)
    monkeypatch.setattr(chosen_path, "MAX_LEVELS", depth)
    rows = near_copies(8)
    check_components(chosen_path.similar(documents(*rows), words=4).collect(), rows, 4)


def test_blocks_are_bounded_by_shingles(spark):
    pool = spark.createDataFrame([(1, k, k, 300_000) for k in range(40)] + [(2, k, k, 10) for k in range(40)],
                                 "node long, class long, root long, n_shingles long")
    rows = chosen_path.dealt(pool).collect()
    assert {(r["one"], r["two"]) for r in rows if r["node"] == 2} == {(0, 0)}
    block = {r["class"]: r["own"] for r in rows if r["node"] == 1}
    assert len(set(block.values())) > 6
    met = Counter()
    for one, two in {(r["one"], r["two"]) for r in rows if r["node"] == 1}:
        group = [r["class"] for r in rows if (r["node"], r["one"], r["two"]) == (1, one, two)]
        met.update((a, b) for a in group for b in group if a < b and (one == two or block[a] != block[b]))
    assert met == Counter({(a, b): 1 for a in range(40) for b in range(a + 1, 40)})


def test_a_shared_passage_falls_apart(documents, monkeypatch):
    """Documents that share a third of their words are large nodes at first, and small ones further down."""
    monkeypatch.setattr(chosen_path, "SMALL", 20)
    passage = " ".join(f"licence{k}" for k in range(30))
    own = [" ".join(f"{k}x{n}" for n in range(50)) for k in range(1000)]
    rows = [(k, f"{passage} {text}") for k, text in enumerate(own)] + [(1000 + k, f"{passage} {text} end") for k, text in enumerate(own[:50])]
    compared = []
    dealt = chosen_path.dealt
    monkeypatch.setattr(chosen_path, "dealt", lambda pool: compared.append(pool) or dealt(pool))

    def found():
        return {r["doc_id"]: r["component_id"] for r in chosen_path.similar(documents(*rows), words=4).collect()}

    expected = {k: k % 1000 for k in range(1050)}
    assert found() == expected
    monkeypatch.setattr(chosen_path, "MAX_LEVELS", 3)
    assert found() == expected
    deep, flat = ([r["count"] for r in pool.groupBy("node").count().collect()] for pool in compared)
    assert max(flat) > 3 * max(deep)
    assert sum(n * n for n in flat) > 10 * sum(n * n for n in deep)


def hub_and_copies(copies=500, seed=3):
    """An original and copies that are similar to it alone: five edits of 200 words each, apart from one another."""
    draw = random.Random(seed)
    hub = [f"w{k}" for k in range(200)]
    rows = [(copies, " ".join(hub))]
    for k in range(copies):
        copy = list(hub)
        for edit, place in enumerate(draw.sample(range(0, 200, 8), 5)):
            copy[place + 3] = f"e{k}x{edit}"
        rows.append((k, " ".join(copy)))
    return rows


def test_copies_that_only_a_hub_links_stay_one_group(documents):
    rows = hub_and_copies()
    sets = [brute_sets(text, 4) for _, text in rows]
    assert all(100 * len(sets[0] & s) >= 80 * len(sets[0] | s) for s in sets)
    alike = sum(100 * len(a & b) >= 80 * len(a | b) for a, b in zip(sets[1:], sets[2:], strict=False))
    assert alike < 10
    assert {r["component_id"] for r in chosen_path.similar(documents(*rows), words=4).collect()} == {0}


def test_one_of_each_group_stays(documents):
    rows = near_copies(9)
    table = documents(*rows, rows[5], rows[5], (None, rows[5][1]), (None, "alone with no id"), extra=("llm_id", "component"))
    kept = chosen_path.deduplicated(table)
    assert kept.columns == table.columns
    _, roots = brute_components(rows, 5)
    least = {}
    for (number, text), root in zip(rows, roots, strict=True):
        least[root] = min(number, least.get(root, number))
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([*least.values(), None])
    assert chosen_path.deduplicated(documents()).count() == 0 and chosen_path.similar(documents()).count() == 0


def test_components_of_chains_and_stars(spark):
    draw = random.Random(11)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 700)] + [(3, 3), (9, 8), (8, 9)]
    draw.shuffle(edges)
    found = {r["vertex"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**{i: 100 for i in range(100, 161)}, **{i: 500 for i in range(500, 700)}, 8: 8, 9: 8}


def test_roots_of_parents(spark):
    parents = [(i - 1, i) for i in range(1, 40)] + [(50, 60), (50, 61), (60, 62)]
    found = {r["vertex"]: r["root"] for r in roots_of(spark.createDataFrame(parents, "u long, v long")).collect()}
    assert found == {**{i: 0 for i in range(40)}, 50: 50, 60: 50, 61: 50, 62: 50}
    assert roots_of(spark.createDataFrame([], "u long, v long")).count() == 0


def test_sets_are_whole():
    texts = ["A b\x0bc d e", "", None, "a", "x y z x y z x y z", "é É x B", "long " * 5 + "text " * 50_000]
    for size in (1, 4, 5):
        for text, found in zip(texts, shingles.shingle_sets(texts, size), strict=True):
            assert len(found) == len(brute_sets(text, size))
    same = shingles.shingle_sets(["A B c", "a b\tC", "a b c d"], 4)
    assert (same[0] == same[1]).all() and not shingles.linked(same[0], same[2], 80) and not shingles.linked(same[0][:0], same[0][:0], 0)


def host_texts(spark, *pages, host="h.example.org"):
    """The texts of pages of one host, in order."""
    rows = [(k, f"http://{host}/{k}", page) for k, page in enumerate(pages)]
    found = html_template.extracted(spark.createDataFrame(rows, "page_id long, url string, html string"))
    return [r["text"] for r in sorted(found.collect(), key=lambda r: r["page_id"])]


def test_constant_texts_inside_an_article_are_its_template(spark):
    page = "<html><body><article><h1>Head {0}</h1><p>Story {0} of many</p><p>Read us every day</p><div><p>Story {0} ends</p></div><section><p>All about us</p></section></article></body></html>"
    assert host_texts(spark, *[page.format(k) for k in range(6)]) == [f"Head {k} Story {k} of many Story {k} ends" for k in range(6)]
    same = "<html><body><i>{0}</i><article><p>The same story</p></article></body></html>"
    assert html_blocks.main_text(html_blocks.read(same)[0], {b.token for b in html_blocks.read(same)[0][1:]}) == "{0}"
    assert host_texts(spark, *[f"<html><body><nav>{k}</nav><article><p>The same story</p></article></body></html>" for k in range(4)]) == ["The same story"] * 4


def test_main_element_has_most_of_the_text():
    long = "A long text of the page with all that it has to say."
    assert long in text_of(f"<main><div>{long}</div><article>teaser</article></main>")
    assert long in text_of(f"<div>{long}</div><article>teaser</article>")
    assert text_of(f"<div>menu</div><main><article>{long}</article><p>more</p></main>") == long


def test_names_around_a_page_do_not_empty_it(spark):
    long = "A long text of the page with all that it has to say."
    for name in ("class='layout has-sidebar'", "id='page-with-comments'", "class=no-ads", "class=search", "class='share'", "class=form", "class=related", "id=login", "class='widget'"):
        assert text_of(PAGE.format(main=f"<div {name}><article><p>{long}</p></article></div>")) == long, name
        assert long in text_of(f"<html><body><div {name}><p>{long}</p></div></body></html>"), name
    assert text_of(f"<form><main><p>{long}</p></main></form>") == long and text_of(f"<form id=f><p>{long}</p></form>") == long
    assert text_of(f"<article><p>{long}</p><section class='share-price'>12.50</section><p class='alert'>Mind this</p></article>") == f"{long} 12.50 Mind this"
    assert text_of(f"<article><p>{long}</p></article><div id=comments><article class=comment>No</article></div><div hidden><article>{long}</article></div>") == long
    page = "<html><body><article><h1>Head {0}</h1><p>Story {0} of many</p><p class=alert>Log in for more</p></article></body></html>"
    assert host_texts(spark, *[page.format(k) for k in range(4)]) == [f"Head {k} Story {k} of many" for k in range(4)]


def test_copies_of_a_page_are_no_template(spark):
    page = "<html><body><div class=top>Welcome to us</div><div class=text><p>Story {0} of many</p></div></body></html>"
    assert host_texts(spark, *[page.format(1)] * 4, page.format(2)) == ["Welcome to us Story 1 of many"] * 4 + ["Welcome to us Story 2 of many"]
    rows = [("http://h.example.org/", page.format(k)) for k in (1, 1, 2, 2, 3, 3)]
    found = spark.createDataFrame(rows, "url string, html string")
    assert sorted(r["text"] for r in html_template.extracted(found).collect()) == [f"Story {k} of many" for k in (1, 1, 2, 2, 3, 3)]
    vectors = html_template.occurrences(found).select("pages", "vector").distinct().collect()
    assert {r["pages"] for r in vectors} == {3} and all(r["vector"] for r in vectors)


@pytest.mark.parametrize("percent", [79, 0, 101])
def test_thresholds_that_would_lose_links_are_refused(documents, percent):
    with pytest.raises(ValueError):
        chosen_path.similar(documents((1, "one two three")), percent=percent)


def test_ranges_of_ids_follow_the_length_of_texts(spark, documents, monkeypatch):
    monkeypatch.setattr(syncmers, "RANGE_CHARS", 1000)
    docs = documents(*[(i, "a b " * (5 if i % 50 else 2000)) for i in range(1000)])
    rows = docs.select("doc_id", "text")
    edges = syncmers._edges(rows)
    assert edges[-1] == 999 and set(range(0, 1000, 50)) <= set(edges)
    lengths = {r.doc_id: len(r.text) for r in rows.collect()}
    sizes, low = [], -1
    for edge in edges:
        sizes.append(sum(lengths[i] for i in range(low + 1, edge)))
        low = edge
    # Beside the document that ends it, a range holds its share: drawn like an exponential.
    assert max(sizes) < 12_000 and len(edges) > 30
    monkeypatch.setattr(syncmers, "RANGES", 5)
    assert len(syncmers._edges(rows)) < 40
    monkeypatch.setattr(syncmers, "RANGES", 1_000_000)
    many = {tuple(r) for r in syncmers.compared(docs).collect()}
    monkeypatch.setattr(syncmers, "RANGE_CHARS", 10**9)
    assert many == {tuple(r) for r in syncmers.compared(docs).collect()} and len(many) == 1000
    assert syncmers._edges(rows.limit(0)) == []
