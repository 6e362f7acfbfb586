"""End-to-end workflows composed from the operators (the three driver programs

* :func:`build_labeled_dataset` — click log → grouped, sampled, click-model
  labels, per-wiki NDCG stats, written as Parquet with column metadata.
* :func:`build_folds` — labeled feature rows → group k-fold → fold files and
  per-wiki statistics.
* :func:`train_and_tune` — folds → staged parameter search → final model.

Only per-wiki summaries reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions.columns import with_column_metadata
from ..operators import click_model, clicks, folds, grouping, rank_model, ranking_metrics, sampling, selection
from ..session import cut_lineage
from ..sources import io


def build_labeled_dataset(log: DataFrame, wikis: Sequence[str] | None = None, samples_per_wiki: int = 1_000_000,
                          min_sessions: int = 10, tolerance: float = 0.5, seed: int = 54321,
                          iterations: int = 40, min_docs: int = 10, max_docs: int = 20,
                          default_rel: float = 0.5, gamma: float = 0.9,
                          output: str | None = None) -> tuple[DataFrame, dict]:
    """Raw click log (wikiid, q_by_ip_day, query, session_id, hits, clicks) →
    labeled hits (wikiid, query, norm_query_id, hit_page_id, weight,
    hit_position, label, relevance) plus stats {wiki: {n_obs, ndcg…}}."""
    cleaned = clicks.clean_click_log(log, wikis)
    hits = clicks.explode_hits(cleaned)
    grouped = grouping.group_queries(hits, min_sessions=min_sessions, norm_query_col=None)
    counts, sampled = sampling.sample_queries(grouped, samples_per_wiki, seed)
    # The sample feeds sessions, labels and metrics: write it once (reliable
    # checkpoint in the shared folder), which also keeps later plans short.
    sampled = cut_lineage(sampled)
    sessions = clicks.eligible_sessions(clicks.session_hits(sampled), min_docs, max_docs)
    relevance = click_model.click_model(sessions, iterations, default_rel, gamma)
    all_hits, labeled = clicks.label_hits(sampled, relevance)
    gate = clicks.sample_gate(labeled, counts, samples_per_wiki, tolerance)
    clicks.assert_sample_gate(gate)
    weighted = ranking_metrics.ndcg(all_hits, 10, query_cols=("wikiid", "query", "session_id"))
    unweighted = ranking_metrics.ndcg(labeled, 10, query_cols=("wikiid", "query"))
    stats = {r.wikiid: {"n_obs": r.n_obs} for r in gate.collect()}  # one row per wiki
    for name, df in (("click_log_weighted_ndcg@10", weighted), ("click_log_ndcg@10", unweighted)):
        for r in df.collect():  # one row per wiki
            stats.setdefault(r.wikiid, {})[name] = r.ndcg
    labeled = with_column_metadata(labeled, "label", {
        "min_sessions_per_query": min_sessions, "wiki_stats": stats})
    if output:
        io.write_with_metadata(labeled, output)
    return labeled, stats


def build_folds(labeled_features: DataFrame, num_folds: int, output: str | None = None,
                num_workers: int = 1, group_cols: Sequence[str] = ("norm_query_id",)) -> tuple[DataFrame, dict]:
    """Labeled rows with a ``features`` vector → fold column (+ ``num_folds``
    metadata), optional fold files, and per-wiki statistics."""
    k = folds.group_k_fold(labeled_features, num_folds, group_cols=group_cols)
    stats = {r.wikiid: r.num_obs for r in selection.wikis_by_size(k).collect()}  # one row per wiki
    if output:
        folds.write_folds(k, f"{output}/folds", num_workers)
        io.write_stats_json(selection.dataset_summary(k), f"{output}/stats", {"num_folds": num_folds})
    return k, stats


def train_and_tune(folded: DataFrame, num_obs: int, initial_trees: int = 100, final_trees: int | None = 500,
                   iterations: int | None = None, seed: int = 0):
    """Staged search over the size profile's space, then the final model on
    all rows.  Returns (params, trials table, model)."""
    kwargs = {} if iterations is None else {"initial_iterations": iterations}
    base, stages = rank_model.tune_stages(num_obs, initial_trees, final_trees, **kwargs)
    if iterations is not None:
        stages = [(space, min(n, iterations)) for space, n in stages]
    best, trials = rank_model.search_params(folded, stages, base, seed=seed)
    model = rank_model.fit_ranker(folded.drop("fold"), best)
    return best, trials, model

