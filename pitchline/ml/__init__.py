"""Training, evaluation, selection and prediction."""
