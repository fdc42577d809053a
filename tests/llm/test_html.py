"""The line-block distribution against a plain version, and markup that once lost text."""

import random
import time

import pytest

from arealis.llm.html_extract import DIVE, FIRST, SURGE, WINDOW, main_text

LONG = ["word " * 30 + f"end {k}." for k in range(12)]


def plain(blocks, marks):
    """Blocks (text, links, noise, heading, marked): each step by its definition, on whole windows."""
    weight = []
    for text, links, noise, _, marked in blocks:
        w = max(0, len(text) - 2 * links)
        if noise or marks and not marked:
            w = 0
        elif marks and links < len(text):
            w = max(w, SURGE)
        weight.append(w)
    total = [sum(weight[k : k + WINDOW]) for k in range(len(blocks))]
    surge = min([SURGE, *total]) if not total else min(SURGE, max(total))
    pick = lambda strict: [
        k for k, (_, _, _, heading, marked) in enumerate(blocks)
        if weight[k] and total[k] >= surge and (not strict or marked or heading or weight[k] >= FIRST or sum(weight[k : k + 2]) >= SURGE)
    ]
    begins = pick(True) or pick(False)
    ranges, k = [], 0
    while any(b >= k for b in begins):
        start = min(b for b in begins if b >= k)
        end = next((e for e in range(start + 1, len(blocks)) if total[e] < min(DIVE, surge) and sum(weight[e - 1 : e + 1]) < surge), len(blocks))
        k = end + 1
        ranges.append((start, max(e for e in range(start, end) if weight[e]) + 1))
    may = [not b[2] and (b[4] or not marks) for b in blocks]
    keep = set()
    for n, (start, end) in enumerate(ranges):
        keep |= set(range(start, end))
        low, high = ranges[n - 1][1] if n else 0, ranges[n + 1][0] if n + 1 < len(ranges) else len(blocks)
        first = start
        while first > low and may[first - 1] and blocks[first - 1][3]:
            first -= 1
        keep |= set(range(first, start))
        if marks:
            for edge in (range(first - 1, low - 1, -1), range(end, high)):
                run = []
                for e in edge:
                    if not may[e] or weight[e]:
                        break
                    run.append(e)
                keep |= set(run) if len(run) < WINDOW else set()
        if n + 1 < len(ranges):
            keep |= {e for e in range(end, high) if weight[e]}
    return "\n\n".join(blocks[k][0] for k in sorted(keep) if may[k])


def rendered(blocks):
    out, inside = [], False
    for text, links, noise, heading, marked in blocks:
        if marked != inside:
            out.append("<article>" if marked else "</article>")
            inside = marked
        linked = f"<a href=x>{text[:links]}</a>{text[links:]}" if links else text
        tag = "nav" if noise else "h2" if heading else "p"
        out.append(f"<{tag}>{linked}</{tag}>")
    return "<body>" + "\n".join(out) + ("</article>" if inside else "") + "</body>"


@pytest.mark.parametrize("seed", range(4))
def test_same_as_the_plain_version(seed):
    rng = random.Random(seed)
    for _ in range(300):
        marks = rng.random() < 0.5
        blocks, inside = [], False
        for k in range(rng.randint(0, 18)):
            inside = marks and (rng.random() < 0.7 if rng.random() < 0.25 else inside)
            size = rng.choice([4, 12, 30, 70, 150])
            text = (f"b{k} " + "abc " * 40)[:size].strip()
            links = rng.choice([0, 0, 0, len(text), len(text) // 2])
            links = len(text[:links].strip()) if links else 0
            blocks.append((text, links, rng.random() < 0.1, rng.random() < 0.15, inside))
        blocks = [(t, a, n, h and not n, m) for t, a, n, h, m in blocks]
        marked = [b for b in blocks if b[4]]
        if any(2 * b[1] >= len(b[0]) for b in marked):  # articles that are mostly links are teasers: another rule
            blocks = [b for b in blocks if not b[4] or 2 * b[1] < len(b[0])]
        has_mark = any(b[4] and not b[2] for b in blocks)
        assert main_text(rendered(blocks)) == plain(blocks, has_mark), blocks


def test_the_distribution_decides():
    """The same markup with other lengths and links gives another result, inside a marked article and without one."""
    page = lambda middle, a="<article>", b="</article>": main_text(a + f"<p>{LONG[0]}</p>" + "".join(f"<p>{m}</p>" for m in middle) + f"<p>{LONG[1]}</p>" + b)
    links = [f"<a href=x>Another page number {k}</a>" for k in range(5)]
    assert page(links) == "\n\n".join(LONG[:2])
    assert page(links[:2]) == "\n\n".join([LONG[0], "Another page number 0", "Another page number 1", LONG[1]])
    assert page(["Brief."] * 5) == "\n\n".join([LONG[0], *["Brief."] * 5, LONG[1]])
    short, body = "".join(f"<p>Item {k}</p>" for k in range(6)), "".join(f"<p>{x}</p>" for x in LONG[:3])
    assert main_text(short + body + short) == "\n\n".join(["Item 5", *LONG[:3], "Item 0"])


def test_text_that_was_lost():
    body = [f"<p>{x}</p>" for x in LONG[:3]]
    want = "\n\n".join(LONG[:3])
    assert main_text(f"<article>{body[0]}</article><p>Advert here</p><article>{body[1]}</article><article>{body[2]}</article>") == want
    assert main_text(f'<body><div class="wrapper with-sidebar">{"".join(body)}</div></body>') == want
    assert main_text(f'<body><div class="page sidebar-layout"><div id="left-sidebar"><p>Side text of some length</p></div>{"".join(body)}</div></body>') == want
    assert main_text(f"<body><form action=x><nav>Menu</nav><main>{''.join(body)}</main></form></body>") == want
    short = [f"Short paragraph {k}." for k in range(6)]
    assert main_text("".join(body) + "".join(f"<p>{x}</p>" for x in short) + "".join(body)) == "\n\n".join([*LONG[:3], *short, *LONG[:3]])
    assert main_text(f"<article>{body[0]}<object data=x>{body[1]}{body[2]}</article>") == want


def test_comments_and_teasers_go():
    body = f"<article><h1>T</h1><p>{LONG[0]}</p></article>"
    opinions = "".join(f"<article><p>{x}</p></article>" for x in LONG[1:9])
    assert main_text(f"<body>{body}<section id='comments'>{opinions}</section></body>") == f"T\n\n{LONG[0]}"
    teasers = "".join(f"<article><a href=x><h3>Another text {k}</h3></a></article>" for k in range(4))
    assert main_text(f"<body>{body}<div>{teasers}</div></body>") == f"T\n\n{LONG[0]}"


def test_time_is_linear():
    for page in ("<div>" * 60_000 + LONG[0], "<a \"=' " * 60_000, "<p>" * 60_000 + "x", "<li><ul>" * 30_000, '<a b="' * 60_000, "<!--" * 60_000, "<script>" * 60_000):
        start = time.process_time()
        main_text(page)
        assert time.process_time() - start < 10
