"""footfall: behaviour-log features, sampling, selection and evaluation as Spark plans."""
