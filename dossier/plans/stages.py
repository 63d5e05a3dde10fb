"""The whole run from CSV files to scored documents, one committed stage after each build."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.operators.repeats import MAX_REPEATS, find_repeats
from dossier.plans.documents import KEY, build_customer_accounts, build_customer_documents
from dossier.plans.scoring import FLAG, WATCH_LIST, score_link
from dossier.sources.files import (
    read_accounts,
    read_addresses,
    read_customer_accounts,
    read_customer_documents,
    read_customers,
)
from dossier.sources.stored import commit_stage, fingerprint, is_made_from, read_manifest


def run_flat(
    customers: DataFrame,
    accounts: DataFrame,
    addresses: DataFrame,
    out_dir: str,
    countries: list[str] = WATCH_LIST,
    flag: str = FLAG,
    mode: str = "strict",
    resume: bool = True,
    buckets: int | None = None,
    **limits,
) -> DataFrame:
    """Scored documents of the flat inputs; the two stages stay in ``out_dir``, each committed as a whole.

    A stage that was made from the same files in the same way is not made again,
    so that a run that was cut off goes on where it was; ``resume=False`` makes all
    anew. Inputs that are not read from files are never taken to be the same.

    The first stage is in ``buckets`` by customer (as many as there are shuffle
    partitions, if not given), so that the second one reads it without a shuffle.
    With customers repeated very often it is not, as a bucket would hold all of one.

    Repeated customers are found once, for both builds. ``limits`` are those of
    ``attach_children``.
    """
    spark = customers.sparkSession
    accounts_path = f"{out_dir}/customer_accounts"
    documents_path = f"{out_dir}/customer_documents"
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = limits.pop("max_repeats", MAX_REPEATS)
    first = fingerprint([customers, accounts], "customer_accounts", mode)
    made = resume and is_made_from(spark, accounts_path, first)
    second = fingerprint([addresses], "customer_documents", mode, first) if made else None
    if not (made and is_made_from(spark, documents_path, second)):
        if "repeats" not in limits:
            limits["repeats"] = find_repeats(customers, KEY, most)
        dealt = None if limits["repeats"].table is not None else buckets
        if not made:
            built = build_customer_accounts(customers, accounts, mode, partitions=dealt, **limits)
            commit_stage(built, accounts_path, first, KEY, dealt)
        second = first and fingerprint([addresses], "customer_documents", mode, first)
        stage = read_customer_accounts(spark, accounts_path)
        stored = read_manifest(spark, accounts_path).buckets
        limits["partitions"] = None if dealt is None else stored
        built = build_customer_documents(stage, addresses, mode, **limits)
        commit_stage(built, documents_path, second)
    return score_link(read_customer_documents(spark, documents_path), countries, flag)


def write_counted(
    documents: DataFrame,
    path: str,
    countries: list[str] = WATCH_LIST,
    flag: str = FLAG,
) -> DataFrame:
    """Score ``documents``, store them with their flag at ``path``, and count the linked ones meanwhile.

    The result is that of ``count_linked``, without a second reading of the documents:
    the count is taken of the rows as they are written, and stays in the manifest.
    """
    scored = score_link(documents, countries, flag)
    commit_stage(scored, path, counts={"linkedCustomers": F.count_if(flag)})
    return stored_count(documents.sparkSession, path)


def stored_count(spark: SparkSession, path: str) -> DataFrame:
    """``count_linked`` of documents stored by ``write_counted``, read from the manifest alone."""
    manifest = read_manifest(spark, path)
    if manifest is None or "linkedCustomers" not in manifest.counts:
        raise ValueError(f"no count is stored at {path}")
    return spark.range(1).select(F.lit(manifest.counts["linkedCustomers"]).cast("bigint").alias("linkedCustomers"))


def run_stages(
    spark: SparkSession,
    customers_csv: str,
    accounts_csv: str,
    addresses_csv: str,
    out_dir: str,
    mode: str = "strict",
    **options,
) -> DataFrame:
    """``run_flat`` over CSV files."""
    return run_flat(
        read_customers(spark, customers_csv, mode),
        read_accounts(spark, accounts_csv, mode),
        read_addresses(spark, addresses_csv, mode),
        out_dir,
        mode=mode,
        **options,
    )
