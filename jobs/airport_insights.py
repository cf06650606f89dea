"""spark-submit jobs/airport_insights.py --ride-hailing P --green P --yellow P
--zone-lookup CSV --output DIR [--zones 'LaGuardia Airport' 'JFK Airport']"""

from _common import parser, session


def main(argv=None, spark=None):
    """Run the job; a passed-in session is used and left running."""
    p = parser("Airport pickups/dropoffs reports")
    p.add_argument("--ride-hailing", required=True)
    p.add_argument("--green", required=True)
    p.add_argument("--yellow", required=True)
    p.add_argument("--zone-lookup", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--zones", nargs="+", default=None)
    p.add_argument("--unmatched", choices=("keep", "zero"), default="keep")
    a = p.parse_args(argv)
    from trip_engine.plans import airport_insights
    from trip_engine.specs import ZoneSpec
    spec = ZoneSpec(names=tuple(a.zones)) if a.zones else ZoneSpec()
    own = spark is None
    spark = spark or session("airport-insights", a.master)
    airport_insights.run(spark, a.ride_hailing, a.green, a.yellow, a.zone_lookup, a.output,
                         spec, a.unmatched)
    if own:
        spark.stop()


if __name__ == "__main__":
    main()
