"""Fleet deployment analytics as Spark jobs.

Hubs, devices, services, process models, access rights, deployments and sync
state are tables; every operator is a function from DataFrames to DataFrames.
"""
