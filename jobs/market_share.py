"""spark-submit jobs/market_share.py --requests PARQUET --output DIR --first D --last D"""

from _common import parser, session


def main(argv=None, spark=None):
    """Run the job; a passed-in session is used and left running."""
    p = parser("Daily market share of ride-hailing services")
    p.add_argument("--requests", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--first", required=True)
    p.add_argument("--last", required=True)
    p.add_argument("--services", nargs="+", default=["Uber", "Lyft"])
    a = p.parse_args(argv)
    from trip_engine.plans import market_share
    own = spark is None
    spark = spark or session("market-share", a.master)
    market_share.run(spark, a.requests, a.output, a.first, a.last, tuple(a.services))
    if own:
        spark.stop()


if __name__ == "__main__":
    main()
