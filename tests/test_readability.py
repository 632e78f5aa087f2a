"""Main text by shallow features: planted articles among menus, and the same tree in plain Python."""

import random
import re

from pyspark.sql import functions as F

from millrace.functions import readability

MENU = "<div class=nav><ul>" + "".join(f"<li><a href='/{i}'>Menu entry {i}</a></li>" for i in range(12)) + "</ul></div>"
FOOT = "<footer><div>Copyright</div><div><a href='/x'>Terms</a> | <a href='/y'>Privacy policy</a></div></footer>"
STORY = [f"Sentence {k} of the story tells what happened on the campus that evening, and who came to see it, at length." for k in range(6)]


def brute(html):
    html = re.sub(readability.HIDDEN_PATTERN, " ", html)
    plain = lambda x: " ".join(re.sub(r"<[^>]*>", " ", x).split())
    found = []
    for part in re.split(readability.BLOCK_PATTERN, html):
        words, links = plain(part).split(), plain(" ".join(re.findall(r"(?is)<a\b[^>]*>(.*?)</a\s*>", part))).split()
        if words:
            found.append((" ".join(words), len(words), len(links) / len(words)))
    out = []
    for k, (text, n, linked) in enumerate(found):
        before, after = found[k - 1] if k else ("", 0, 0), found[k + 1] if k + 1 < len(found) else ("", 0, 0)
        if linked <= 0.333333:
            if before[2] <= 0.555556:
                keep = not (n <= 16 and after[1] <= 15 and before[1] <= 4)
            else:
                keep = not (n <= 40 and after[1] <= 17)
            if keep:
                out.append(text)
    text = "\n".join(out)
    return text[:8000] if len(text) >= 100 else None


def texts(spark, pages):
    rows = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    return [r[1] for r in rows.select("i", readability.main_text(F.col("html"))).orderBy("i").collect()]


def test_articles_among_menus(spark):
    story = "".join(f"<p>{s}</p>" for s in STORY)
    page = f"<html><head><title>T</title></head><body>{MENU}<div id=x><h1>Title</h1>{story}</div><script>var a = '<p>{'word ' * 50}</p>'</script><!-- <p>{'hidden ' * 50}</p> -->{MENU}{FOOT}</body></html>"
    got = texts(spark, [page, MENU + FOOT, "", None, "<p>short</p>", page.upper()])
    assert all(s in got[0] for s in STORY) and not any(w in got[0] for w in ("Menu", "Privacy", "var a", "hidden", "word"))
    assert got[1:5] == [None] * 4 and STORY[2].upper() in got[5] and "MENU" not in got[5]
    assert texts(spark, ["<div>" + "word " * 5000 + "</div>"])[0] == ("word " * 5000)[:8000]


def test_same_as_brute_force(spark):
    rng = random.Random(2)
    word = lambda n: " ".join(rng.choice(("festival", "campus", "&amp;", "축제", "a", "the\n stage")) for _ in range(n))

    def block():
        tag = rng.choice(("p", "div", "li", "td", "h2", "section", "DIV", "span"))
        inner = rng.choice((word(rng.choice((1, 4, 5, 15, 16, 17, 18, 40, 41))), f"<a href=x>{word(rng.randint(1, 9))}</a>", f"{word(rng.randint(1, 9))} <a>{word(rng.randint(1, 9))}</a> <b>{word(2)}</b>", "", " \n "))
        return f"<{tag} class='c'>{inner}</{tag}>{rng.choice(('', '<br>', '<br/>', '<hr>', '<!-- x <p> -->', '<style>p {}</style>'))}"

    pages = ["".join(block() for _ in range(rng.randint(0, 25))) for _ in range(200)]
    want = [brute(p) for p in pages]
    assert texts(spark, pages) == want and sum(w is not None for w in want) > 100
