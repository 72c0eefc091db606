"""Write docs/PLANS.md: the key lines of each headline plan over the stored layout."""
import os
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from threatlake.catalog import PLANS  # noqa: E402
from threatlake.plans.layout import StoredTables, scan_summary, write_domain_tables  # noqa: E402
from threatlake.session import get_spark, scratch_path  # noqa: E402
from threatlake.sources.bindings import Tables  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark("local[8]", 8)
    root = scratch_path(spark, f"plans-{uuid.uuid4().hex[:12]}")
    write_domain_tables(Tables(spark, sf), root)
    st = StoredTables(spark, root, sf)
    out = ["# Physical plans of the headline queries (stored layout, AQE initial plan)", "",
           "Generated by `tools/explain_headline.py`; only scan / pruning / pushdown / join / exchange",
           "lines of `explain(\"formatted\")` are kept.", ""]
    for name in HEADLINE:
        df = PLANS[name](st)
        df.write.format("noop").mode("overwrite").save()
        out += [f"## {name}", "", "```"] + [ln.rstrip()[:160] for ln in scan_summary(df)] + ["```", ""]
    os.makedirs("docs", exist_ok=True)
    with open("docs/PLANS.md", "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
