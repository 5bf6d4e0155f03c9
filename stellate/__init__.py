"""Star-schema data lakes on Spark.

Main entry points:
  * ``stellate.session.build_session`` - session with the settings the jobs rely on;
  * ``stellate.operators`` - dense keys, dimension builds, null-safe star joins, reports;
  * ``stellate.plans.job.build_lake`` - the whole batch job; ``python -m stellate`` runs it;
  * ``stellate.streaming.start_fire_refresh`` - event-driven refresh.
"""
