"""spark-submit jobs/trip_duration.py --train CSV --test CSV --output DIR"""

from _common import parser, session


def main(argv=None, spark=None):
    """Run the job; a passed-in session is used and left running."""
    p = parser("Train the duration model and predict the test trips")
    p.add_argument("--train", required=True)
    p.add_argument("--test", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--unit", choices=("km", "mi"), default="km")
    p.add_argument("--shape", choices=("round", "trunc", "raw"), default="round")
    p.add_argument("--audit-table", default=None)
    a = p.parse_args(argv)
    from trip_engine.plans import trip_duration
    from trip_engine.specs import FeatureConfig
    own = spark is None
    spark = spark or session("trip-duration", a.master)
    trip_duration.run(spark, a.train, a.test, a.output, FeatureConfig(unit=a.unit, impute=False),
                      a.shape, a.audit_table)
    if own:
        spark.stop()


if __name__ == "__main__":
    main()
