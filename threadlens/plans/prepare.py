"""From raw thread folders and key files to example sets — the data
preparation step of the original project as one composition.

    posts  = scan (Twitter / Reddit)          S2, S3, N1, N2
    labels = key documents                    S1; dev before train (N4)
    fold   = per conversation                 N6 (Twitter) or given (Reddit)
    edges  = structure.json -> edge rows      S6, T1; hand-made repairs (N9);
             Twitter keeps only the root named like the conversation N8
    examples = build_examples                 T13, ordered by
             (fold, platform twitter < reddit, topic, conversation)
    reports                                   N3, N5, N7, N11, corrupt lines

A conversation is known by its folder, topic and name, so one name in two
folders or topics is two conversations. A post given several times is one post
(``features.one_post``): the source first, else the last file and line.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.operators import normalize as NO
from threadlens.operators import tree as TR
from threadlens.operators.examples import build_examples
from threadlens.operators.features import one_post
from threadlens.session import materialize
from threadlens.sources import threads as TH

PLATFORM_RANK = {"twitter": 0, "reddit": 1}


@dataclass
class ThreadFolder:
    """One folder of threads (a path, or a ``Listed`` one): ``platform`` 'twitter' or 'reddit'; ``fold``
    fixes the fold of every conversation in it (Reddit folders, test data),
    otherwise it comes from the labels of the replies (N6)."""
    root: str | TH.Listed
    platform: str
    fold: str | None = None


@dataclass
class Prepared:
    """The example sets and what the original prints while it loads."""
    examples: DataFrame
    posts: DataFrame
    reports: dict[str, DataFrame] = field(default_factory=dict)


def _conversation(no: int):
    """The key of a conversation of folder ``no``."""
    return F.concat_ws("/", F.lit(str(no)), "topic", "conv_name")


def folder_posts(spark: SparkSession, folder: ThreadFolder, labels: DataFrame,
                 priority: Sequence[str] = ("dev", "train"), no: int = 0) -> DataFrame:
    """Posts of one folder with topic, split, label, stance and fold, one row
    per post; ``conv_id`` is the key, ``conv_name`` the folder's name."""
    if folder.platform == "twitter":
        posts = NO.normalize_posts(TH.scan_twitter(spark, folder.root), "twitter")
    else:
        posts = NO.normalize_posts(TH.scan_reddit_raw(spark, folder.root), "reddit").withColumn("topic", F.lit(""))
    posts = posts.withColumn("conv_name", F.col("conv_id")).withColumn("conv_id", _conversation(no))
    posts = one_post(posts.withColumn("platform", F.lit(folder.platform)).withColumn("platform_rank", F.lit(PLATFORM_RANK[folder.platform])))
    posts = NO.attach_labels(posts, labels, priority)
    # file-name order of the reply files decides the fold
    folds = NO.assign_fold(posts, order_col="file_path", fixed=folder.fold)
    return posts.join(folds, "conv_id").withColumn("fixed_fold", F.lit(folder.fold is not None))


def repaired_edges(spark: SparkSession, folder: ThreadFolder, no: int = 0, fixes: DataFrame | None = None) -> DataFrame:
    """Reply edges of one folder, all roots, with ``conv_name``. ``fixes(conv_id,
    post_id, new_parent, fix_pos)``: moved subtrees, by the conversation's own name."""
    edges = TH.scan_edges(spark, folder.root, folder.platform, with_topic=True)
    if fixes is not None:
        edges = TR.graft(edges, fixes, keep=["topic"])
    return edges.withColumn("conv_name", F.col("conv_id")).withColumn("conv_id", _conversation(no)) \
        .select("conv_id", "parent_id", "post_id", "sib_pos", "conv_name")


def kept_roots(edges: DataFrame, folder: ThreadFolder) -> DataFrame:
    """Twitter's other roots go; repairs come before: a moved subtree may hang below one of them."""
    return (TR.prune_roots(edges, F.col("conv_name")) if folder.platform == "twitter" else edges).drop("conv_name")


def folder_edges(spark: SparkSession, folder: ThreadFolder, no: int = 0, fixes: DataFrame | None = None) -> DataFrame:
    """The reply edges of one folder that examples are made from."""
    return kept_roots(repaired_edges(spark, folder, no, fixes), folder)


def prepare(spark: SparkSession, folders: Sequence[ThreadFolder], labels: DataFrame, lexicon,
            priority: Sequence[str] = ("dev", "train"), gazetteer=None, fixes: DataFrame | None = None) -> Prepared:
    """Example sets of all folders, one row per post and fold (column
    ``fold``; write them with ``sources.examples_io.write_examples``), and the
    reports: ``missing_text`` (N3), ``unlabelled`` (N5), ``split_trees`` (N7),
    ``unknown_labels`` (N11), ``corrupt_lines``, ``unreachable`` (posts that a
    repair has cut off from every root, or put below themselves)."""
    posts, edges, corrupt, rooted = None, None, None, None
    for no, f in enumerate(folders):
        f = replace(f, root=TH.listed(spark, f.root, f.platform, stored=True))  # posts, trees and corrupt lines come from one listing, read once
        p, r = folder_posts(spark, f, labels, priority, no), repaired_edges(spark, f, no, fixes)
        c = TH.corrupt_lines(spark, f.root, f.platform)
        if fixes is None:
            r, e = None, kept_roots(r, f)
        else:  # read twice; only a repair can cut a post off, a nested document cannot
            r = materialize(r, "repaired")
            e = kept_roots(r, f)
        posts = p if posts is None else posts.unionByName(p, allowMissingColumns=True)
        edges = e if edges is None else edges.unionByName(e)
        corrupt = c if corrupt is None else corrupt.unionByName(c)
        rooted = r if rooted is None else rooted.unionByName(r)
    # read several times (presence in the walk, conversations, features, reports): the JSON is parsed once
    posts = materialize(posts, "posts")
    examples = build_examples(posts, edges, lexicon, conv_order=["platform_rank", "topic", "conv_name", "conv_id"], gazetteer=gazetteer)
    return Prepared(examples, posts, {
        "missing_text": NO.missing_text(posts),
        "unlabelled": NO.unlabelled(posts, labels).select("conv_id", "post_id"),
        "split_trees": NO.split_trees(posts.where(~F.col("fixed_fold"))),
        "unknown_labels": NO.unknown_labels(posts),
        "corrupt_lines": corrupt,
        **({} if rooted is None else {"unreachable": TR.unreachable(rooted)}),
    })


def prepare_examples(spark: SparkSession, folders: Sequence[ThreadFolder], labels: DataFrame, lexicon,
                     priority: Sequence[str] = ("dev", "train"), gazetteer=None, fixes: DataFrame | None = None) -> DataFrame:
    """The example sets of ``prepare``."""
    return prepare(spark, folders, labels, lexicon, priority, gazetteer, fixes).examples
