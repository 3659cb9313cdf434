"""python -m quarrylink STAGE --store PATH …: the stages from the command line."""

from __future__ import annotations

import argparse

from .plans import providers, report, stages
from .session import build_session
from .sources.config import Settings
from .sources.landing import load_tasks
from .sources.storage import Store


def _arguments() -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="quarrylink")
    p.add_argument("stage", choices=("classify", "embed", "retrieve", "resolve", "report"))
    p.add_argument("--store", required=True, help="path of the tables")
    p.add_argument("--config", default="config.txt")
    p.add_argument("--input", help="classify: folder of workbooks; embed: folder of the four register tables")
    p.add_argument("--timeline")
    p.add_argument("--limit", type=int, default=0, help="classify a proportional sample of so many tasks")
    p.add_argument("--force-refresh", action="store_true")
    p.add_argument("--embed-batch-size", type=int, default=256)
    p.add_argument("--top-k", type=int, default=30)
    p.add_argument("--workers", type=int, default=1)
    p.add_argument("--min-link-confidence", type=float, default=0.75)
    p.add_argument("--max-links-per-task", type=int, default=3)
    p.add_argument("--llm-timeout-sec", type=float, default=60.0)
    p.add_argument("--retry-max", type=int, default=2)
    p.add_argument("--retry-backoff-sec", type=float, default=2.0)
    p.add_argument("--output", default="timeline_reconciliation_report.xlsx")
    p.add_argument("--offline", action="store_true", help="rules, hashed vectors and nearest candidates instead of a model")
    return p.parse_args()


def main() -> None:
    a = _arguments()
    s = Settings.load(a.config)
    s.top_k, s.least_confidence, s.most_links = a.top_k, a.min_link_confidence, a.max_links_per_task
    s.retries, s.backoff, s.timeout = a.retry_max, a.retry_backoff_sec, a.llm_timeout_sec
    spark = build_session()
    store = Store(spark, a.store)
    base = s.values.get("LLM_BASE_URL", "https://api.openai.com/v1")
    if a.offline:
        classifier, embedder, resolver = providers.RuleClassifier(), providers.HashEmbedder(), providers.ReplayResolver()
        s.embedding_model = embedder.model
    else:
        key = s.required("LLM_API_KEY")
        classifier = resolver = providers.HttpChat(base, key, s.chat_model, s.timeout)
        embedder = providers.HttpEmbedder(base, key, s.embedding_model, s.timeout)
    if a.stage == "classify":
        tasks, problems = load_tasks(spark, a.input)
        problems.show(truncate=False)
        stages.classify(store, tasks, classifier, s.chat_model, a.limit).groupBy("TaskClass").count().show()
    elif a.stage == "embed":
        views = [spark.read.parquet(f"{a.input}/{name}") for name in ("register", "consolidated", "descriptions", "enriched")]
        print(*stages.embed(store, *views, embedder, a.timeline, a.embed_batch_size, a.force_refresh))
    elif a.stage == "retrieve":
        print(stages.retrieve(store, s.embedding_model, a.timeline, s.top_k).count())
    elif a.stage == "resolve":
        notes, counts = stages.resolve_links(store, resolver, s, a.timeline, a.workers)
        counts.show()
        report.write_csv(notes, f"{a.store}/diagnostics")
    else:
        view = stages.link_view(store, a.timeline)
        report.write(view, a.output)
        report.totals(view).show()


if __name__ == "__main__":
    main()
