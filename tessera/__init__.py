"""Record linkage and data-quality analytics as lazy DataFrame plans."""
