"""Print the names of the queries of the given modules."""

import pathlib
import sys

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from statlake.queries import QUERIES  # noqa: E402

wanted = tuple(sys.argv[1:])
print(" ".join(n for n, f in QUERIES.items() if not wanted or f.__module__.endswith(wanted)))
