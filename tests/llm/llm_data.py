"""Small tables with every odd case, and plain versions of what the operators share."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " score string, kept string, node string, line string, root string, block string"
)
NAMES = "the of and house river stone green water light paper market winter garden summer bread".split()


def words(n, seed):
    draw = random.Random(seed)
    return [draw.choice(NAMES) + draw.choice(["", "s", "ly", "ing"]) + draw.choice("abcdefgh") for _ in range(n)]


def text(n, seed):
    found = words(n, seed)
    return "\n".join(" ".join(found[i : i + 12]) for i in range(0, n, 12))


def near(of, seed):
    """A copy with one word changed."""
    found = of.split(" ")
    found[random.Random(seed).randrange(len(found))] = f"changed{seed}"
    return " ".join(found)


def rows():
    base = [text(60 + 7 * i, i) for i in range(30)]
    found = [(i, t, "en" if i % 3 else "de", f"s{i % 4}") for i, t in enumerate(base)]
    found += [(100 + i, base[0], "en", "s0") for i in range(5)]
    found += [(200 + i, near(base[1], i), "en", None) for i in range(5)]
    found += [
        (300, None, None, None), (301, "", "en", "s1"), (302, " \t\n ", "en", None), (303, "123 ... !", "de", "s9"),
        (304, "x", "en", "s9"), (305, "日本語の文章 ▁ 🎉 \0 é", None, "日"), (306, text(20_000, 77), "de", "s2"),
        (307, "w" * 50_000, "en", "s2"), (7, base[7], "en", "s3"), (7, base[7], "en", "s3"), (8, "another text of id eight", "en", "s0"),
        (None, base[9], "en", "s1"), (None, "a text without any id at all", None, None), (-5, base[3], "en", "s1"),
    ]
    return [(i, t, l, s, len(t or ""), "a", "b", None, "d", "e", "f") for i, t, l, s in found]


def odd_documents(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


class Groups:
    def __init__(self, items):
        self.up = {x: x for x in items}

    def top(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        self.up[self.top(a)] = self.top(b)
