"""borderlake: a Spark lakehouse that judges, masks and border-checks personal data.

Raw CSV lands in bronze, YAML contracts decide which records are fit, rejected
records go to quarantine with a reason, fit records become typed and masked
silver tables with a residency verdict, and gold marts report on them.
"""
