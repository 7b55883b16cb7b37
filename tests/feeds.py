"""Small feeds for tests and a plain replay of them, event by event."""

import random

from filelake import schemas
from filelake.constants import MAX_ARCHIVE_BYTES, MAX_FILE_BYTES

TYPES = {".jpg": "images", ".pdf": "docs", ".mp3": "media"}


def change(seq, kind, path, ident=None, rev=None, size=10):
    name = path.rsplit("/", 1)[-1]
    return (seq, kind, ident and "id:" + ident, name, path, path.lower(), rev, size, None)


def frame(spark, rows):
    return spark.createDataFrame(rows, schemas.CHANGE)


def random_feed(seed, n, paths=12, ids=9, hot=0.0):
    """Files that move between paths, archives among them. ``hot`` is the share of one path and id."""
    rng = random.Random(seed)
    exts = [".jpg", ".pdf", ".zip", ".exe"]
    rows = []
    for seq in range(n):
        p, i = rng.randrange(paths), rng.randrange(ids)
        if rng.random() < hot:
            p, i = 0, 0
        kind = rng.choice(["file", "file", "file", "deleted", "folder"])
        size = rng.choice([1, 10, MAX_FILE_BYTES, MAX_FILE_BYTES + 1, MAX_ARCHIVE_BYTES + 1])
        path = f"/d/p{p}{exts[p % 4]}"
        if kind == "file":
            rows.append(change(seq, kind, path, f"i{i}", f"r{rng.randrange(2)}", size))
        else:
            rows.append(change(seq, kind, path))
    return rows


def replay(rows, members=(), path_index=None, rev_index=None):
    """Outcomes by seq, path index and revision index; ``members`` is ``(zip id, inner path)``."""
    where, revs, outcomes = dict(path_index or {}), dict(rev_index or {}), {}
    for seq, kind, raw_id, name, _, path, rev, size, _ in sorted(rows):
        ident = raw_id and raw_id.removeprefix("id:")
        suffix = name[name.rfind("."):].lower() if "." in name else ""
        if kind == "folder":
            continue
        if kind == "deleted":
            zipped = path.endswith(".zip")
            if zipped:
                for child in [p for p in where if p.startswith(path + "!/")]:
                    del where[child]
            old = where.pop(path, None)
            revs.pop(old, None)
            outcomes[seq] = "archive_deleted" if zipped else "deleted" if old else "skipped"
            continue
        zipped, same = suffix == ".zip", revs.get(ident) == rev
        limit = MAX_ARCHIVE_BYTES if zipped else MAX_FILE_BYTES
        if zipped:
            result = "unchanged" if same else "skipped" if size > limit else "archive"
        else:
            bad = suffix not in TYPES or size > limit
            result = "skipped" if bad else "unchanged" if same else "synced"
        outcomes[seq] = result
        if result == "archive":
            for owner, inner in members:
                if owner == ident:
                    where[f"{path}!/{inner}"] = f"{ident}___{inner.replace('/', '_')}"
        if result in ("archive", "synced"):
            where[path] = ident
            revs[ident] = rev
    return outcomes, where, revs
