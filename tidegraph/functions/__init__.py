"""Column functions that the operators share; all of them stay in the JVM."""

from .arrays import dot, l2_normalise, pretty, squared_l2, to_double
from .codes import MAX_CLUSTERS, STATUS, cluster_of, electrode_of, neuron_id, rate, status_label

__all__ = ["MAX_CLUSTERS", "STATUS", "cluster_of", "dot", "electrode_of", "l2_normalise", "neuron_id", "pretty", "rate", "squared_l2", "status_label", "to_double"]
