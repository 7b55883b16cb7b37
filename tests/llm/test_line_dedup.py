import random

from filelake.llm import line_dedup


def split(text):
    """Lines with a word, each with the blank lines after it, and what stands before them."""
    parts = []
    for line in text.split("\n"):
        if line.strip(" \t\r\n\v\f") or not parts:
            parts.append(line)
        else:
            parts[-1] += "\n" + line
    return parts


def brute(rows, min_words):
    """Deletes line by line: lines of any run with enough words of which an earlier copy exists."""
    order = sorted({(i if i is not None else 2**63 - 1, t) for i, t in rows if t}, key=lambda r: r[0])
    lines = {}
    for d in order:
        lines[d] = [(p, s.strip(" \t\r\n\v\f")) for p, s in enumerate(split(d[1])) if s.strip(" \t\r\n\v\f")]
    seen, gone = set(), {d: set() for d in order}
    runs = []
    for d in order:
        for s in range(len(lines[d])):
            words = 0
            for e in range(s, len(lines[d])):
                words += lines[d][e][1].count(" ") + 1
                if words >= min_words:
                    runs.append((d, s, e))
    for d, s, e in runs:
        content = tuple(t for _, t in lines[d][s : e + 1])
        if content in seen:
            gone[d] |= {lines[d][n][0] for n in range(s, e + 1)}
        seen.add(content)
    out = []
    for i, t in rows:
        if not t:
            out.append((i, t))
            continue
        d = (i if i is not None else 2**63 - 1, t)
        out.append((i, "\n".join(s for p, s in enumerate(split(t)) if p not in gone[d])))
    return out


def corpus(seed, n=40):
    """Ids differ, so that the order of documents is that of the ids alone."""
    random.seed(seed)
    pool = [" ".join(random.choices("abcdefg", k=random.choice([1, 2, 3, 8]))) for _ in range(12)]
    passages = [[" ".join(random.choices("stuvwxyz", k=random.choice([1, 4, 9]))) for _ in range(random.randint(1, 9))] for _ in range(6)]
    rows = []
    for i in range(n):
        lines = []
        for _ in range(random.randint(0, 6)):
            lines += random.choice([[random.choice(pool)], random.choice(passages), ["", "  "], ["only here %d" % random.randrange(10**9)]])
        rows.append((i, "\n".join(f"  {line} " if random.random() < 0.1 else line for line in lines)))
    return rows + [(100, None), (101, ""), (102, "\n \n"), (3, rows[3][1]), (None, rows[5][1] + "\nlast")]


def key(rows):
    return sorted(rows, key=str)


def test_equals_all_runs_written_out(docs):
    for seed, min_words in ((1, 5), (2, 12), (3, 1), (4, 33)):
        rows = corpus(seed)
        found = line_dedup.line_dedup(docs(rows), min_words=min_words)
        assert set(docs(rows).columns) < set(found.columns)
        assert key([(r["doc_id"], r["text"]) for r in found.collect()]) == key(brute(rows, min_words))


def test_passage_goes_from_later_documents_only(docs):
    passage = "\n".join(" ".join(f"word{n}{m}" for m in range(20)) for n in range(3))
    rows = [(9, "start\n" + passage + "\nend"), (2, passage), (5, "short line\n" + passage[: passage.index("\n")]), (7, "short line\nclean")]
    found = {r["doc_id"]: (r["text"], r["removed_lines"]) for r in line_dedup.line_dedup(docs(rows)).collect()}
    assert found[2] == (passage, None)
    assert found[9][0] == "start\nend" and [tuple(s) for s in found[9][1]] == [(1, 3)]
    # One line of 20 words is below the limit, and repeated short lines are left alone.
    assert found[5] == (rows[2][1], None) and found[7] == (rows[3][1], None)


def test_very_long_text_of_one_repeated_line(docs):
    text = "\n".join(["the same line of seven words again"] * 20_000)
    (row,) = line_dedup.line_dedup(docs([(1, text)])).collect()
    # Copies may overlap: the run from the second line on is a copy of the one from the first.
    assert row["text"] == "the same line of seven words again"


def test_empty_table(docs):
    assert line_dedup.line_dedup(docs([])).count() == 0
    assert line_dedup.line_dedup(docs([(1, None), (2, "")])).count() == 2
