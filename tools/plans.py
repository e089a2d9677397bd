"""Print the physical plan tree and scan details of registered queries.

Usage: python tools/plans.py [sf_dir] [name ...]  > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from orderloom.plans import catalog  # noqa: E402
from orderloom.session import get_session  # noqa: E402

DEFAULT = ["release_item_pipeline", "convenience_charge_pipeline", "charge_latest_per_key",
           "top3_per_group", "nth_highest_rank", "effective_dated_join", "flatmap_words",
           "last_six_months"]


def digest(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree, _, details = text.partition("\n\n\n")
    keep = []
    for block in details.split("\n\n"):
        head = block.strip().splitlines()[0] if block.strip() else ""
        if "Scan" in head:
            keep += [l for l in block.splitlines() if l.startswith(("(", "PushedFilters", "ReadSchema"))]
    return tree.strip() + "\n\n" + "\n".join(keep)


def main() -> None:
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in args if not a.startswith("/")] or DEFAULT
    spark = get_session()
    qs = catalog.queries()
    for name in names:
        print(f"### {name}\n\n```\n{digest(qs[name](spark, sf))}\n```\n")


if __name__ == "__main__":
    main()
