"""spark-submit jobs/map_layers.py --trips CSV --output DIR [--n 50000 --seed 42]"""

from _common import parser, session


def main(argv=None, spark=None):
    """Run the job; a passed-in session is used and left running."""
    p = parser("Sampled map point layers and trip density grid")
    p.add_argument("--trips", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--n", type=int, default=50000)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--cell-deg", type=float, default=1e-2)
    a = p.parse_args(argv)
    from trip_engine.plans import map_layers
    own = spark is None
    spark = spark or session("map-layers", a.master)
    map_layers.run(spark, a.trips, a.output, a.n, a.seed, a.cell_deg)
    if own:
        spark.stop()


if __name__ == "__main__":
    main()
