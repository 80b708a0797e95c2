"""Job entry for spark-submit: run the sites over stored pages, or only report what would be found.

    spark-submit --py-files folioflow.zip folioflow/job.py run --pages P --root R --batch 7 --sites itl,iaum
    spark-submit ... folioflow/job.py discover --pages P --root R
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from folioflow.plans.site_run import dry_run, run_sites
from folioflow.rules import default_rules
from folioflow.session import build_session, drop_cuts, join_path
from folioflow.sources.pages import read_pages, with_site


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="folioflow")
    parser.add_argument("action", choices=("run", "discover"))
    parser.add_argument("--pages", required=True, help="stored pages (page_id, url, html, fetched_at)")
    parser.add_argument("--root", required=True, help="shared folder of the library")
    parser.add_argument("--batch", type=int, default=0, help="number of the run; a number again repeats that run")
    parser.add_argument("--sites", help="comma list; all built-in sites when absent")
    parser.add_argument("--all-pages", action="store_true", help="take every page that passes the URL filter")
    parser.add_argument("--skip-captcha", action="store_true")
    given = parser.parse_args(args)

    spark = build_session()
    rules = default_rules(given.sites.split(",") if given.sites else None)
    pages = read_pages(spark, given.pages)
    pages = pages if "site" in pages.columns else with_site(pages, rules)
    if given.action == "discover":
        path = join_path(given.root, "discovered", f"batch={given.batch}")
        dry_run(pages, rules, given.root, given.batch).write.mode("overwrite").parquet(path)
        listings, urls = spark.read.parquet(path).agg(F.count("*"), F.coalesce(F.sum("n_links"), F.lit(0))).first()
        print(f"{urls} URLs in {listings} listings, by listing in {path}")
    else:
        options = {"crawl_links": not given.all_pages, "skip_captcha": given.skip_captcha}
        print(run_sites(pages, rules, given.root, given.batch, **options))
    drop_cuts(spark)


if __name__ == "__main__":
    main()
