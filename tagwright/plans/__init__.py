"""Jobs that put operators together: training, versioned models, evaluation."""
