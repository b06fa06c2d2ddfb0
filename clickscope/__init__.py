"""clickscope: shop click-stream reports as Spark DataFrame plans and
Structured Streaming queries.

``sources`` bind and parse the inputs, ``functions`` hold column expressions,
``operators`` the reports, ``streaming`` the ad-click stream queries, ``sinks``
the writers, ``plans`` the registry, oracle SQL, stream replay and SQL views.
"""
