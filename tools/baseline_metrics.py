"""
counts and rounds, tokens/s for T1/T3/T8.  Writes BASELINE_OWN.md.

Usage: python tools/baseline_metrics.py [sf_dir ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402


def timed(fn):
    t = time.perf_counter()
    out = fn()
    return out, time.perf_counter() - t


def main():
    dirs = sys.argv[1:] or ["/root/testdata/sf0.01", "/root/testdata/sf0.1"]
    from tessera.operators import bpe as B
    from tessera.operators import dedup as D
    from tessera.operators import sequences as S
    from tessera.plans.adapters import table
    from tessera.session import get_session
    spark = get_session("local[8]", **{"spark.sql.shuffle.partitions": "16"})
    lines = ["# Own baseline (round 1, local[8], 16 shuffle partitions)", "",
             "| sf | measure | value |", "|---|---|---|"]
    for sf in dirs:
        name = os.path.basename(sf.rstrip("/"))
        docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
        n_docs = docs.count()
        stats: dict = {}
        _, sec = timed(lambda: D.near_dup(docs, "text", "doc_id", ["lang"], D.NearDup(), stats)
                       .write.format("noop").mode("overwrite").save())
        kept = D.near_dup(docs, "text", "doc_id", ["lang"]).where(~F.col("near_dup_kept")).count()
        lines += [f"| {name} | D3 first-wins seconds | {sec:.2f} |",
                  f"| {name} | D3 rows/s | {n_docs / sec:.0f} |",
                  f"| {name} | D3 bands x rows | {stats.get('bands')} x {stats.get('rows')} |",
                  f"| {name} | D3 candidate docs / memberships | {stats.get('candidate_docs')} / {stats.get('candidate_memberships')} |",
                  f"| {name} | D3 rounds | {stats.get('rounds', 0)} |",
                  f"| {name} | D3 dropped docs (no pairs verified: LSH semantics) | {kept} |"]
        freq, sec = timed(lambda: B.piece_frequencies(docs).agg(F.sum("n")).first()[0])
        lines.append(f"| {name} | T1 pieces/s | {freq / sec:.0f} |")
        toks, sec = timed(lambda: docs.select(F.size(S.codepoint_ids(F.col("text"), None)).alias("n")).agg(F.sum("n")).first()[0])
        lines.append(f"| {name} | T8 (whole text) tokens/s | {toks / sec:.0f} |")
        model, _ = B.learn_merges(B.piece_frequencies(docs), num_merges=8)
        toks, sec = timed(lambda: B.encode(docs.withColumnRenamed("doc_id", "id"), model)
                          .agg(F.sum(F.size("input_ids"))).first()[0])
        lines.append(f"| {name} | T3 (8 merges) tokens/s | {toks / sec:.0f} |")
        print("\n".join(lines[-9:]), flush=True)
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "BASELINE_OWN.md"), "w") as fh:
        fh.write("\n".join(lines) + "\n")


if __name__ == "__main__":
    main()
