"""Jobs made of several operators: cross-validation, search, train and evaluate."""
