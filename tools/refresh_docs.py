"""Refresh the generated parts of README.md and docs/COVERAGE.md (query counts and list)."""
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from threatlake.catalog import QUERIES  # noqa: E402
from threatlake.oracle.queries import ORACLE  # noqa: E402


def main():
    q, o = len(QUERIES), len(ORACLE)
    rows_only = sorted(set(QUERIES) - set(ORACLE))
    readme = open("README.md").read()
    readme = re.sub(r"queries\(\) \(\d+\), oracle_sql\(\) \(\d+\)", f"queries() ({q}), oracle_sql() ({o})", readme)
    readme = re.sub(r"All \d+ oracle-backed queries", f"All {o} oracle-backed queries", readme)
    open("README.md", "w").write(readme)
    cov = open("docs/COVERAGE.md").read()
    cov = cov.split("\n## All registered queries")[0].rstrip("\n")
    lines = ["", "", "## All registered queries", "",
             f"{q} queries, {o} with an oracle (rows-only: " + ", ".join(f"`{x}`" for x in rows_only) + ").", ""]
    groups = {}
    for name in sorted(QUERIES):
        groups.setdefault(name.split("_")[0], []).append(name)
    for g, names in groups.items():
        lines.append(f"* **{g}** ({len(names)}): " + ", ".join(f"`{n}`" for n in names))
    open("docs/COVERAGE.md", "w").write(cov + "\n".join(lines) + "\n")
    print(q, o, rows_only)


if __name__ == "__main__":
    main()
