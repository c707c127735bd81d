"""License scans against alignment at every offset."""

import random

from ledgerline.llm import license_scan as ls


def everywhere(text, templates, least):
    words, out = ls.words_of(text), []
    for name, template in ((n, ls.words_of(t)) for n, t in templates.items()):
        slack, own = max(2, len(template) // 10), set()
        for s in range(-len(template) - slack, len(words) + slack + 1):
            low = max(0, s - slack)
            pairs = ls.align(words[low : max(0, s + len(template) + slack)], template)
            if pairs and len(pairs) >= least * len(template):
                own.add(ls.Find(name, len(pairs) / len(template), low + pairs[0][0], low + pairs[-1][0] + 1))
        out += ls._apart(own)
    return sorted(out, key=lambda f: (f.start, f.license))


def test_short_and_changed_wordings():
    scanner = ls.Scanner(ls.TEMPLATES)
    assert [(f.license, f.coverage) for f in scanner.scan("Available under CC BY-NC 4.0")] == [("notice:cc-by-nc", 0.8)]
    assert [f.license for f in ls.Scanner({"t": "use it as you wish"}).scan("do use it as you wish ok")] == ["t"]


def test_scan_is_alignment_at_every_offset():
    rng = random.Random(5)
    templates = {k: v for k, v in ls.TEMPLATES.items() if k.startswith("notice:") or k == "zlib"} | {"tiny": "use it as you wish", "again": "a b a b a c a b"}
    found = 0
    for least in (0.6, 0.8, 1.0):
        scanner = ls.Scanner(templates)
        for _ in range(40):
            words = []
            for name in rng.choices(list(templates), k=2):
                own = [w for w in ls.words_of(templates[name]) if rng.random() > 0.12]
                for _ in range(rng.randrange(3)):
                    own.insert(rng.randrange(len(own) + 1), rng.choice(["x", "the", "under", "a"]))
                words += [*rng.choices(["x", "the", "license", "b", "software"], k=rng.randrange(6)), *own]
            text = " ".join(words)
            got = scanner.scan(text, least)
            assert got == everywhere(text, templates, least)
            found += len(got)
    assert found > 50
